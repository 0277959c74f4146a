import datetime as dt

from pyspark.sql import functions as F

from tallyframe.functions.expr import clean_amount, clip, parse_bilingual_date, strict_amount
from tallyframe.operators import clean


def test_clean_amount_edges(spark):
    vals = ["1.234.567", "-", "", "$ 1,234.50", None, "12", "-5.5", "abc"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.x for r in df.select(clean_amount("s").alias("x")).collect()]
    assert got == [0.0, 0.0, 0.0, 1234.5, 0.0, 12.0, -5.5, 0.0]
    strict = [r.x for r in df.select(strict_amount("s").alias("x")).collect()]
    assert strict[3] is None and strict[5] == 12.0


def test_bilingual_dates(spark):
    vals = ["2025 Ene 05", "2025 JAN 05", "", "junk", "2025-02-03", "05/08/1997", "2024 Dic 31"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.x for r in df.select(F.to_date(parse_bilingual_date("s")).alias("x")).collect()]
    assert got == [dt.date(2025, 1, 5), dt.date(2025, 1, 5), None, None, dt.date(2025, 2, 3),
                   dt.date(1997, 8, 5), dt.date(2024, 12, 31)]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (50.0,), (500.0,), (None,)], "x double")
    assert [r.c for r in df.select(clip("x", 0, 100).alias("c")).collect()] == [0.0, 50.0, 100.0, None]


def test_filter_cascade_levels(spark):
    df = spark.createDataFrame([(1, 5), (2, 15), (3, 25)], "id int, v int")
    strict = lambda: F.col("v") > 100
    assert sorted(r.id for r in clean.filter_cascade(df, strict(), F.col("v") > 10).collect()) == [2, 3]
    assert sorted(r.id for r in clean.filter_cascade(df, strict(), F.col("v") > 100).collect()) == [1, 2, 3]
    assert sorted(r.id for r in clean.filter_cascade(df, F.col("v") == 5, F.col("v") > 10).collect()) == [1]


def test_impute_mean_mode_unknown_when_empty(spark):
    df = spark.createDataFrame([(1.0, None, "x"), (None, None, "y"), (3.0, None, "x")],
                               "a double, b string, c string")
    out = clean.impute_mean_mode(df, ["a"], ["b", "c"]).collect()
    assert [r.a for r in out] == [1.0, 2.0, 3.0]
    assert {r.b for r in out} == {"Desconocido"}


def test_impute_median_falls_back(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (10.0, None), (4.0, None)], "a double, b double")
    out = clean.impute_median(df, ["a", "b"]).collect()
    assert out[1].a == 4.0 and {r.b for r in out} == {0.0}


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    z = [r.x for r in clean.standardize(df, ["x"]).collect()]
    import numpy as np
    assert abs(np.mean(z)) < 1e-12 and abs(np.std(z) - 1) < 1e-12


def test_one_hot_drop_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert clean.one_hot(df, "k").columns == ["k", "k_b", "k_c"]


def test_safe_double_equals_try_cast(spark):
    vals = ["1", " 2.5 ", "-3e2", "1d", "2f", "inf", "-Infinity", "NaN", "click", "", None, "1.2.3", "+7", "0x10"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    from tallyframe.functions.expr import safe_double
    a = [r.x for r in df.select(safe_double("s").alias("x")).collect()]
    b = [r.x for r in df.select(F.col("s").try_cast("double").alias("x")).collect()]
    import math
    assert all((x is None and y is None) or (x == y) or (math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))
