"""Scratch tables in the shared folder, connected components, stage cleanup of columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back: later steps
    start from files all executors share, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b long) -> (node, label = smallest node).

    Rounds of contraction, each written to the shared folder: every node points to its
    smallest neighbour (or itself), pointers are followed a few times, and edges are redrawn
    between the nodes pointed to; edges inside a group vanish, so later rounds are small.
    Only whether edges are left reaches the driver."""
    left = scratch(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
                   .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rounds or left.limit(1).count():
        point = (left.groupBy(F.col("a").alias("node"))
                 .agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
        point = scratch(point, "point")
        for _ in range(2):
            jump = point.select(F.col("node").alias("label"), F.col("label").alias("further"))
            point = scratch(point.join(jump, "label").select("node", F.col("further").alias("label")), "point")
        rounds.append(point)
        left = (left.join(point.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
                .join(point.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
                .filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        left = scratch(left, "edges")
    labels = rounds[0]
    for point in rounds[1:]:
        then = point.select(F.col("node").alias("label"), F.col("label").alias("then"))
        labels = labels.join(then, "label", "left").select("node", F.coalesce("then", "label").alias("label"))
    return scratch(labels, "labels")
