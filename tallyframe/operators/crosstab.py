"""Cross tabulation, row shares, group rates and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crosstab(df: DataFrame, row: str, col: str, values: Sequence, agg: Column | None = None,
             fill=0) -> DataFrame:
    """Pivot ``col`` (levels given up front: no extra distinct job) into columns of
    ``agg`` (default: row count) per ``row``; missing cells -> ``fill``. The pivot is a
    single group-by on (row, col) underneath, with partial aggregation."""
    agg = agg if agg is not None else F.count(F.lit(1))
    p = df.where(F.col(row).isNotNull()).groupBy(row).pivot(col, list(values)).agg(agg)
    return p.na.fill(fill)


def row_share(df: DataFrame, part: str, rest: str, out: str = "share_pct") -> DataFrame:
    """part / (part + rest) * 100."""
    tot = F.col(part) + F.col(rest)
    return df.withColumn(out, F.when(tot != 0, F.col(part) * 100.0 / tot))


def group_rate(df: DataFrame, keys: Sequence[str], flag: str, digits: int = 2) -> DataFrame:
    """sum(flag) / count * 100, rounded; one row per group."""
    return df.groupBy(*keys).agg(F.round(F.avg(F.col(flag).cast("double")) * 100, digits).alias("rate_pct"),
                                 F.count(F.lit(1)).alias("rows"))


def stack_labels(df: DataFrame, real: str, pred: str, tag: str = "source", out: str = "label") -> DataFrame:
    """Long form of two label columns: (source='real'|'pred', label)."""
    a = df.select(F.lit("real").alias(tag), F.col(real).alias(out))
    b = df.select(F.lit("pred").alias(tag), F.col(pred).alias(out))
    return a.unionByName(b)


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def set_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def add_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows by column name (missing columns NULL)."""
    return df.unionByName(rows, allowMissingColumns=True)
