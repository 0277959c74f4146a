import datetime as dt
import json


from tallyframe.operators import calendar, clean, joins
from tallyframe.sources import files
from tallyframe.streaming import monitor


def test_delimited_sniff_and_decimal_comma(spark, tmp_path):
    p = tmp_path / "serie.csv"
    p.write_text("Fecha;Valor\n2024-01-31;4,5\n2024-02-29;4,75\nbad;x\n", encoding="utf-8")
    df = files.read_delimited(spark, str(p))
    assert df.columns == ["Fecha", "Valor"]
    s = files.normalise_series(df, "60").orderBy("fecha").collect()
    assert [tuple(r) for r in s] == [(dt.date(2024, 1, 31), 4.5), (dt.date(2024, 2, 29), 4.75)]
    assert files.normalise_series(df, "60").columns == ["fecha", "tasa_uvr"]


def test_strings_typed_write_roundtrip(spark, tmp_path):
    p = tmp_path / "students.csv"
    p.write_text("Nombre,Edad,Carrera,Promedio\nAna,21,Fisica,8.5\nLuis,x,Quimica,9.1\n", encoding="utf-8")
    s = files.read_strings(spark, str(p))
    assert dict(s.dtypes)["Edad"] == "string"
    t = files.read_typed(spark, str(p), "Nombre string, Edad int, Carrera string, Promedio double")
    rows = t.orderBy("Nombre").collect()
    assert rows[0].Edad == 21 and rows[1].Edad is None
    out = tmp_path / "out"
    files.write_csv(t.select("Nombre", "Promedio"), str(out))
    back = files.read_strings(spark, str(out)).orderBy("Nombre").collect()
    assert [r.Promedio for r in back] == ["8.5", "9.1"]


def test_forecast_document_shape(spark):
    fc = spark.createDataFrame([("a", dt.date(2024, 1, 31), 1.0), ("a", dt.date(2024, 2, 29), float("nan"))],
                               "s string, month date, forecast double")
    m = spark.createDataFrame([("a", 0.5, 0, 1, 1, 10.0, 0.9)],
                              "s string, alpha_ridge double, p int, d int, q int, aic_arima double, "
                              "explained_variance double")
    doc = json.loads(files.forecast_documents(fc, m, ["s"], "month", "forecast", "2024-03-01T00:00:00").first().json)
    assert doc["generated_at"] == "2024-03-01T00:00:00"
    assert doc["predictions"] == {"2024-01-31": 1.0, "2024-02-29": None}
    assert doc["metrics"]["training"]["arima_order"] == [0, 1, 1]


def test_small_helpers(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0)], "id int, v double")
    assert [r.v for r in clean.sort_values(df, ["v"]).collect()] == [1.0, 5.0, None]
    assert [r.v for r in clean.sort_values(df, ["v"], False).collect()] == [5.0, 1.0, None]
    assert [r.id for r in clean.tail(df, 2, ["id"]).collect()] == [3, 2]
    assert clean.column_slice(df, 0, 1).columns == ["id"]
    assert clean.resolve_column(df, "V") == "v"
    chk = {r.column: r for r in clean.check_required(df, ["id", "zzz"], 8).collect()}
    assert chk["zzz"].present is False and chk["id"].enough_rows is False


def test_undated_blocks_and_append(spark):
    rows = [("u", None, i, 1.0) for i in range(65)] + [("d", dt.date(2024, 1, 1), 0, 5.0)]
    df = spark.createDataFrame(rows, "id string, t date, k int, v double")
    b = calendar.undated_blocks(df, "id", "k", {"total": "v"}, "t").orderBy("block").collect()
    assert [(r.id, r.block, r.total) for r in b] == [("u", 0, 30.0), ("u", 1, 30.0), ("u", 2, 5.0)]
    hist = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0)], "id string, t date, y double")
    new = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.0), ("a", dt.date(2024, 2, 1), 3.0)],
                                "id string, t date, y double")
    assert sorted(r.y for r in joins.append_actuals(hist, new, "id", "t").collect()) == [2.0, 3.0]


def test_streaming_monitor(spark, tmp_path):
    src = tmp_path / "actuals"
    src.mkdir()
    spark.createDataFrame([("a", dt.datetime(2024, 1, 31), 100.0), ("a", dt.datetime(2024, 2, 29), 150.0),
                           ("b", dt.datetime(2024, 1, 31), 80.0)], "id string, t timestamp, actual double") \
        .write.mode("overwrite").parquet(str(src / "batch1"))
    preds = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 110.0), ("a", dt.datetime(2024, 2, 1), 100.0)],
                                  "id string, t timestamp, predicted double")
    stream = spark.readStream.schema("id string, t timestamp, actual double").parquet(str(src / "*"))
    q = monitor.start_monitor(stream, preds, "id", "t", "actual", "predicted", str(tmp_path / "out"),
                              str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    scored = {(r.id, r.ym): r for r in spark.read.parquet(str(tmp_path / "out" / "scored")).collect()}
    assert abs(scored[("a", "2024-01")].rel_error - 0.1) < 1e-12 and scored[("a", "2024-01")].retrain is False
    assert scored[("a", "2024-02")].retrain is True
    assert scored[("b", "2024-01")].rel_error is None
    def running():
        return {r.id: r for r in monitor.running_errors(spark, str(tmp_path / "out"), "id").collect()}
    assert abs(running()["a"].running_error - (0.1 + 1 / 3) / 2) < 1e-12

    # a restart with new rows adds them; a replayed epoch counts once
    spark.createDataFrame([("a", dt.datetime(2024, 2, 28), 200.0)], "id string, t timestamp, actual double") \
        .write.mode("overwrite").parquet(str(src / "batch2"))
    q = monitor.start_monitor(stream, preds, "id", "t", "actual", "predicted", str(tmp_path / "out"),
                              str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    want = (0.1 + 1 / 3 + 0.5) / 3
    assert running()["a"].n == 3 and abs(running()["a"].running_error - want) < 1e-12
    again = spark.read.parquet(str(tmp_path / "out" / "scored" / "epoch=0")).cache()
    again.count()
    monitor.write_epoch(again, 0, "id", str(tmp_path / "out"))
    assert running()["a"].n == 3 and abs(running()["a"].running_error - want) < 1e-12


def test_forecast_document_frame_form(spark):
    fc = spark.createDataFrame([("a", dt.date(2024, 1, 31), 1.0, 0.5)], "s string, month date, f double, lin double")
    m = spark.createDataFrame([("a", 0.5, 0, 1, 1, 10.0, 0.9)],
                              "s string, alpha_ridge double, p int, d int, q int, aic_arima double, "
                              "explained_variance double")
    doc = json.loads(files.forecast_documents(fc, m, ["s"], "month", ["f", "lin"], "x").first().json)
    assert doc["predictions"] == {"2024-01-31": {"f": 1.0, "lin": 0.5}}
