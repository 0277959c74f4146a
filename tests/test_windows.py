import datetime as dt

import numpy as np
import pandas as pd

from tallyframe.operators import joins, windows


def _series(spark, n=30, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"k": ["a"] * n + ["b"] * n,
                        "t": list(range(n)) * 2,
                        "v": np.round(rng.normal(100, 10, 2 * n), 2)})
    return pdf, spark.createDataFrame(pdf)


def test_rolling_null_until_full(spark):
    pdf, df = _series(spark)
    r = windows.rolling(df, "v", "t", 20, ["k"]).where("k = 'a'").orderBy("t").toPandas()
    want = pdf[pdf.k == "a"].v.rolling(20).mean().to_numpy()
    assert r.rolling_mean.isna().sum() == 19
    assert np.allclose(r.rolling_mean.to_numpy()[19:], want[19:])


def test_undo_diff_roundtrip(spark):
    pdf, df = _series(spark)
    d = windows.diff(df, "v", "t", ["k"]).fillna(0.0, ["diff"])
    from pyspark.sql import functions as F
    base = df.groupBy("k").agg(F.min_by("v", "t").alias("b"))
    lv = windows.undo_diff(d.join(base, "k"), "diff", "t", F.col("b"), ["k"]).toPandas()
    assert np.allclose(lv.level, lv.v)


def test_ffill_bfill(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 7.0), (5, None)], "t int, x double")
    out = [r.x for r in windows.ffill_bfill(df, ["x"], "t").orderBy("t").collect()]
    assert out == [5.0, 5.0, 5.0, 7.0, 7.0]


def test_top_k_two_phase_equals_window(spark):
    pdf, df = _series(spark, n=200)
    got = windows.top_k(df.repartition(7), "v", 5, ["k"], tie="t").toPandas().sort_values(["k", "rank"])
    want = pdf.sort_values(["k", "v", "t"], ascending=[True, False, True]).groupby("k").head(5)
    assert list(got.t) == list(want.t)


def test_argmax_ties_smallest_key(spark):
    df = spark.createDataFrame([("g", 3, 10.0), ("g", 1, 10.0), ("g", 2, 5.0)], "g string, id int, v double")
    assert windows.argmax_row(df, "v", "id", ["g"]).first().id == 1


def test_autocorr_not_centred(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate([1, 2, 3, 4])], "t int, v double")
    a = {r.lag: r.acf for r in windows.autocorr(df, "v", "t", max_lag=10).collect()}
    assert set(a) == {1, 2, 3}
    assert abs(a[1] - (2 + 6 + 12) / 30) < 1e-12


def test_merge_series_full_outer_and_fill(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 3, 1), 3.0)], "month date, a double")
    b = spark.createDataFrame([(dt.date(2024, 2, 1), 20.0)], "month date, b double")
    m = joins.merge_series([a, b], "month").orderBy("month").collect()
    assert [(r.a, r.b) for r in m] == [(1.0, 20.0), (1.0, 20.0), (3.0, 20.0)]
