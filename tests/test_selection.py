"""Sortable bits and radix quantiles against numpy."""

import numpy as np
from pyspark.sql import functions as F

from tallyframe.operators.selection import from_sortable_bits, radix_quantiles, with_sortable_bits

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
         -1.7976931348623157e308, float("inf"), float("-inf"), 1.0, -1.0, 0.1, 3.0]


def test_bits_are_those_of_the_double(spark):
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 2**64, 4000, dtype=np.uint64).view(np.float64)
    powers = 2.0 ** np.arange(-1074, 1024)
    values = np.concatenate([raw[~np.isnan(raw)], powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf), -powers, EDGES])
    rows = (spark.createDataFrame(list(enumerate(values.tolist())), "i int, v double")
            .transform(with_sortable_bits, "v", "b").withColumn("back", from_sortable_bits(F.col("b"))).orderBy("i").collect())
    got = [r.b for r in rows]
    assert [r.back for r in rows] == values.tolist()
    bits = np.abs(values).view(np.int64)
    assert got == np.where(values < 0, -bits, bits).tolist()
    nan = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("nan"),)], "v double")
    b = [r.b for r in with_sortable_bits(nan, "v", "b").collect()]
    assert b[0] == b[2] > b[1]


def test_quantiles_of_edges_and_groups(spark):
    rng = np.random.default_rng(1)
    groups = {"hot": np.concatenate([np.full(5000, 7.0), rng.normal(0, 1e-3, 3000), rng.normal(0, 1e9, 300)]),
              "one": np.array([3.5]), None: np.round(rng.exponential(10, 501), 2), "edges": np.array([v for v in EDGES if np.isfinite(v)]),
              "near": 1 + np.arange(400) * 2.0 ** -52, "signs": rng.normal(0, 1, 1001)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), ("hot", None)]
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: [r[n] for n in names] for r in radix_quantiles(df, "v", probs, ["g"], names).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        v = np.sort(vs)
        for p, x in zip(probs, got[g]):
            h = (len(v) - 1) * p
            lo, hi = v[int(np.floor(h))], v[int(np.ceil(h))]
            assert x == (lo if lo == hi else lo + (h - np.floor(h)) * (hi - lo)), (g, p)
    alone = radix_quantiles(df.filter("g = 'signs'"), "v", [0.5], [], ["m"]).collect()
    assert alone[0].m == np.median(groups["signs"])
    assert radix_quantiles(df.filter("false"), "v", [0.5], [], ["m"]).collect()[0].m is None
    assert radix_quantiles(df.filter("false"), "v", [0.5], ["g"], ["m"]).collect() == []


def test_a_group_of_a_million_needs_no_window_over_its_rows(spark):
    i = F.col("id")
    df = spark.range(0, 1_000_000, 1, 8).select(F.when(i % 10 < 9, "big").otherwise(F.concat(F.lit("s"), i % 7)).alias("g"),
                                                F.when(i % 3 == 0, 1.25).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1000).alias("v"))
    out = radix_quantiles(df, "v", [0.1, 0.5, 0.99], ["g"], ["a", "b", "c"])
    got = {r.g: (r.a, r.b, r.c) for r in out.collect()}
    want = {r.g: tuple(r.q) for r in df.groupBy("g").agg(F.expr("percentile(v, array(0.1, 0.5, 0.99))").alias("q")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 1e-6 for g in got for x, y in zip(got[g], want[g]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    orders = [line for line in plan.splitlines() if "Window [" in line and "RowFrame" in line]
    assert orders and all("Window [sum(_c" in line for line in orders)       # counts of digits, never rows
