"""Positions at a size where range boundaries are sampled, with payload and skew."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators.ranks import group_positions
from tallyframe.operators.stats import quantiles


def _rows(spark):
    i = F.col("id")
    return (spark.range(0, 320_000, 1, 6)
            .withColumn("g", F.when(i % 3 != 0, "hot").when(i % 7 == 0, None).otherwise(F.concat(F.lit("g"), i % 5)))
            .withColumn("v", F.when(i % 2 == 0, 7.0).when(i % 1001 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) / 10))
            .withColumn("payload", F.concat(F.lit("p"), i)))


def test_positions_are_gapless_and_ordered(spark):
    got = group_positions(_rows(spark), ["g"], "v").persist()
    per = got.groupBy("g").agg(F.count("*").alias("c"), F.countDistinct("pos").alias("d"),
                               F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.max("n").alias("n")).collect()
    assert sum(r.c for r in per) == 320_000 and len(per) == 7
    assert all(r.c == r.d == r.hi == r.n and r.lo == 1 for r in per)
    last = F.lag("v").over(Window.partitionBy("g").orderBy("pos"))
    assert got.withColumn("before", last).filter("before > v OR (before IS NOT NULL AND v IS NULL)").count() == 0
    got.unpersist()


def test_quantiles_with_hot_value_and_null_group(spark):
    rows = _rows(spark)
    got = {r.g: (r.q25, r.q90) for r in quantiles(rows, "v", [0.25, 0.9], ["g"]).collect()}
    want = {r.g: (r.a, r.b) for r in rows.groupBy("g").agg(
        F.expr("percentile(v, 0.25)").alias("a"), F.expr("percentile(v, 0.9)").alias("b")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[g][i] - want[g][i]) < 1e-9 for g in want for i in (0, 1))


def test_parts_follow_the_rows_and_cut_hot_values_and_common_beginnings(spark):
    """No part, so no task, holds more than twice its share: one hot group, strings that differ
    only behind a long common beginning, and one value that half of the rows have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        i = F.col("id")
        rows = spark.range(0, 200_000, 1, 4).select(
            F.when(i % 50 == 0, F.lit(None)).otherwise("hot").alias("g"), "id",
            F.when(i % 2 == 0, "a long common beginning of all names").otherwise(
                F.concat(F.lit("a long common beginning of all names #"), F.pmod(F.xxhash64("id"), F.lit(9973)))).alias("name"))
        got = group_positions(rows, ["g"], "name")
        sizes = [r.c for r in spark.read.parquet(*{f.rsplit("/", 1)[0] for f in got.inputFiles()})
                 .groupBy("_part").agg(F.count("*").alias("c")).collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * 200_000 / 8
        per = got.groupBy("g").agg(F.count("*").alias("c"), F.countDistinct("pos").alias("d"), F.min("pos").alias("lo"),
                                   F.max("pos").alias("hi"), F.max("n").alias("n")).collect()
        assert len(per) == 2 and all(r.c == r.d == r.hi == r.n and r.lo == 1 for r in per)
        before = F.lag("name").over(Window.partitionBy("g").orderBy("pos"))
        assert got.withColumn("before", before).filter("before > name").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
