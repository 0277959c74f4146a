"""Positions within groups without a window over their rows.

``Window.partitionBy(g).orderBy(v)`` puts a whole group into one task. ``group_positions``
range-partitions all rows by (group, value, hash of the row), whatever the groups: as many
parts as the shuffle has, of near-equal size, cut anywhere inside a group, a hot value or
strings with one beginning. Every part is sorted, its rows are numbered as they are written,
and the written table is what all later steps read. Two levels of counts then give each
position: rows of the group in earlier parts, and rows before this one in its own part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
    """Inner join on ``keys`` (null equals null) that keeps the left columns and the right's
    other columns."""
    names = [*keys, *extra]
    renamed = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(names)],
                           *[c for c in right.columns if c not in names])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(names)])
    return left.join(renamed, on).drop(*[f"_r{i}" for i in range(len(names))])


def group_positions(df: DataFrame, keys: list[str], order_col: str, pos_col: str = "pos",
                    n_col: str = "n") -> DataFrame:
    """Add 1-based ``pos`` (place within its group by ``order_col``, nulls first; ties ordered
    by a hash of the row, rows equal in everything in any order) and the group size ``n``.
    A null key is a group like any other. Writes the rows once below the checkpoint folder."""
    keys = list(keys)
    by = [*keys, order_col, "_tie"]
    # a task numbers its rows upward from its own multiple of 2^33
    rows = (df.withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(*by).sortWithinPartitions(*by)
            .withColumn("_row", F.monotonically_increasing_id())
            .withColumn("_part", F.shiftright("_row", 33)).drop("_tie"))
    rows = written(rows, "positions")
    parts = rows.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_row").alias("_first"))
    group = Window.partitionBy(*keys)       # one row a part: never more than the shuffle has parts
    upto = F.sum("_c").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = parts.select(*keys, "_part", (upto - F.col("_c") - F.col("_first")).alias("_lead"),
                         F.sum("_c").over(group).alias(n_col))
    out = _null_safe(rows, parts, keys, ["_part"])
    return out.withColumn(pos_col, F.col("_row") + F.col("_lead") + 1).drop("_row", "_part", "_lead")


def series_positions(df: DataFrame, keys: list[str], order_col: str, pos_col: str = "pos",
                     n_col: str = "n") -> DataFrame:
    """The same for period series, one row per entity and period: a window per entity, which
    holds no more rows than the calendar has periods."""
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return df.withColumn(pos_col, F.row_number().over(w.orderBy(order_col)).cast("long")) \
        .withColumn(n_col, F.count(F.lit(1)).over(w))
