"""Exact quantiles by radix selection.

Doubles become 64-bit integers that sort as the doubles do. The wanted ranks of all groups,
columns and quantiles are narrowed down together, 16 bits a round: rows are counted by
(group, digit), running counts over the at most 65,536 digits of a prefix tell which digit
holds which rank, and only rows with such a prefix go on. The first round reads the input
once; the second reads it again and keeps the few rows left, equal values counted as one;
the rest works on those. Nothing is sorted, and no window holds more than 65,536 rows
whatever a group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEAST_NORMAL = 2.0 ** -1022
_INFINITE = 2047 << 52          # bits of infinity; NaN, the greatest double here, is one more


def with_sortable_bits(df: DataFrame, col: str, name: str) -> DataFrame:
    """``df`` with the bits of the double ``col`` as a long ``name`` in the order of the doubles:
    the magnitude's bits, negated for negative values; both zeros are 0, NaN comes last.

    Step by step, so that every step is computed once a row: the optimizer keeps costly
    columns apart that are used more than once."""
    x, a = F.col(col), F.abs(F.col(col))
    df = df.withColumn("_log", F.least(F.floor(F.log2(a)).cast("double"), F.lit(1023.0)))
    df = df.withColumn("_share", a / F.pow(F.lit(2.0), F.col("_log")))
    # log2 is rounded: beside a power of two it may be one off, and the share in [0.5, 4)
    off = F.when(F.col("_share") >= 2, 1).when(F.col("_share") < 1, -1).otherwise(0)
    scaled = F.when(F.col("_share") >= 2, F.col("_share") / 2).when(F.col("_share") < 1, F.col("_share") * 2).otherwise(F.col("_share"))
    normal = ((F.col("_log") + off + 1023).cast("long") * F.lit(1 << 52)) + ((scaled - 1) * F.lit(2.0 ** 52)).cast("long")
    small = (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    df = df.withColumn("_size", F.when(F.isnan(x), F.lit(_INFINITE + 1)).when(a == F.lit(float("inf")), F.lit(_INFINITE))
                       .when(a < F.lit(_LEAST_NORMAL), small).otherwise(normal))
    signed = F.when((x < 0) & ~F.isnan(x), -F.col("_size")).otherwise(F.col("_size"))
    # never null for a value: no null check, which would be computed again below, is inferred
    return df.withColumn(name, F.coalesce(signed, F.lit(0))).drop("_log", "_share", "_size")


def from_sortable_bits(b: Column) -> Column:
    """The double that ``with_sortable_bits`` gave the bits of."""
    size = F.abs(b)
    high = F.shiftright(size, 52)
    low = size.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    value = (F.when(size > F.lit(_INFINITE), F.lit(float("nan"))).when(size == F.lit(_INFINITE), F.lit(float("inf")))
             .when(high == 0, low * F.lit(2.0 ** -1074))
             .otherwise((1 + low / F.lit(2.0 ** 52)) * F.pow(F.lit(2.0), high - 1023)))
    return F.when(b < 0, -value).otherwise(value)


def _holders(counts: DataFrame, over: list[str], prefix: str, ranks: Column) -> DataFrame:
    """Prefixes that hold wanted ranks, with those ranks counted from the prefix's first row."""
    span = Window.partitionBy(*over)
    upto = F.sum("_c").over(span.orderBy(prefix).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = F.filter(ranks, lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_c")))
    mine = F.transform(held, lambda r: F.struct(r["target"].alias("target"), (r["rank"] - F.col("_before")).alias("rank")))
    return (counts.withColumn("_before", upto - F.col("_c")).withColumn("_ranks", mine)
            .filter(F.size("_ranks") > 0).drop("_c", "_before"))


def radix_quantiles(df: DataFrame, col: str, probs: list[float], keys: list[str], names: list[str]) -> DataFrame:
    """One row per group with the quantiles ``probs`` of ``col`` as columns ``names``, linearly
    interpolated between the two nearest ranks (exact). Null values are left out, a null key
    is a group like any other, NaN counts as greatest; a group without values has no row (one
    row of nulls without ``keys``)."""
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    rows = (df.filter(F.col(col).isNotNull())
            .select(group.alias("_g"), F.col(col).cast("double").alias("_v")))
    rows = with_sortable_bits(rows, "_v", "_b")
    first = rows.groupBy("_g", F.shiftright("_b", 48).alias("_p1")).agg(F.count(F.lit(1)).alias("_c"))
    first = first.withColumn("_n", F.sum("_c").over(Window.partitionBy("_g")))
    place = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array(*[F.struct(F.lit(i).alias("target"), end.cast("long").alias("rank")) for i, end in
                      enumerate(end for h in place for end in (F.floor(h), F.ceil(h)))])
    found = _holders(first, ["_g"], "_p1", ranks)
    total = found.select("_g", "_p1", "_n", "_ranks")

    # prefixes are distinct, so this inner join only filters (a semi join would be pushed below the bits)
    left = (rows.withColumn("_p1", F.shiftright("_b", 48)).join(total.select("_g", "_p1"), ["_g", "_p1"])
            .groupBy("_g", "_p1", "_b").agg(F.count(F.lit(1)).alias("_c")))
    wanted, at = total, "_p1"
    for level, shift in ((2, 32), (3, 16), (4, 0)):
        prefix = f"_p{level}"
        now = left.withColumn(prefix, F.shiftright("_b", shift))
        if level > 2:
            now = now.withColumn(at, F.shiftright("_b", shift + 16))
        counts = now.groupBy("_g", at, prefix).agg(F.sum("_c").alias("_c")).join(wanted, ["_g", at])
        wanted = _holders(counts, ["_g", at], prefix, F.col("_ranks")).drop(at)
        at = prefix

    each = wanted.select("_g", "_n", from_sortable_bits(F.col("_p4")).alias("_v"), F.explode("_ranks.target").alias("_t"))
    ends = [F.max(F.when(F.col("_t") == i, F.col("_v"))).alias(f"_e{i}") for i in range(2 * len(probs))]
    done = each.groupBy("_g").agg(F.max("_n").alias("_n"), *ends) if keys else each.agg(F.max("_n").alias("_n"), *ends)
    out = []
    for i, (h, name) in enumerate(zip(place, names)):
        low, high = F.col(f"_e{2 * i}"), F.col(f"_e{2 * i + 1}")
        out.append(F.when(low == high, low).otherwise(low + (h - F.floor(h)) * (high - low)).alias(name))
    return done.select(*[F.col("_g")[k].alias(k) for k in keys], *out)
