"""Projection, filtering, coercion and imputation.

Fill values (means, modes, medians, scaler parameters) are computed in ONE aggregate
and attached to rows by a cross join with that single row (broadcast: one row, bounded),
so the fill stays a projection in the same stage as the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clip  # noqa: F401  (re-exported for callers)

UNKNOWN = "Desconocido"  # fill for a categorical column without any value


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def flatten(df: DataFrame, struct_col: str, sep: str = "_") -> DataFrame:
    """Two-level names -> one level: ``s.a`` becomes ``s_a``."""
    fields = df.schema[struct_col].dataType.fieldNames()
    others = [c for c in df.columns if c != struct_col]
    return df.select(*others, *[F.col(f"{struct_col}.{f}").alias(f"{struct_col}{sep}{f}") for f in fields])


def resolve_column(df: DataFrame, fragment: str) -> str:
    """First column whose lower-case name contains ``fragment`` (plan-time, no scan)."""
    for c in df.columns:
        if fragment.lower() in c.lower():
            return c
    raise KeyError(f"no column contains {fragment!r}")


def check_required(df: DataFrame, required: Sequence[str], min_rows: int | None = None) -> DataFrame:
    """One row per required column: present?, null count (one aggregate) and whether the
    table reaches ``min_rows``."""
    present = [c for c in required if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")] + [(F.count(F.lit(1)) - F.count(c)).alias(f"_n{i}")
                                                  for i, c in enumerate(present)]
    g = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(c in df.columns).alias("present"),
                     (F.col(f"_n{present.index(c)}") if c in present else F.lit(None).cast("long")).alias("nulls"))
            for c in required]
    out = g.select("_rows", F.explode(F.array(*rows)).alias("_s")).select("_rows", "_s.*")
    enough = F.lit(True) if min_rows is None else F.col("_rows") >= min_rows
    return out.withColumn("enough_rows", enough).withColumnRenamed("_rows", "rows")


def filter_cascade(df: DataFrame, strict: Column, relaxed: Column) -> DataFrame:
    """Rows meeting ``strict``; if none, rows meeting ``relaxed``; if none, all rows.

    One pass: tag each row with the strictest level it meets (0, 1, 2), take the global
    minimum level (a one-row aggregate) and keep rows at or below it.
    """
    lvl = F.when(strict, 0).when(relaxed, 1).otherwise(2)
    tagged = df.withColumn("_lvl", lvl)
    m = tagged.agg(F.min("_lvl").alias("_min"))
    return tagged.crossJoin(F.broadcast(m)).where(F.col("_lvl") <= F.col("_min")).drop("_lvl", "_min")


def isin(df: DataFrame, col: str, values: DataFrame | Sequence) -> DataFrame:
    """Membership filter: literal list -> ``isin``; a DataFrame of values -> left semi
    join (Catalyst broadcasts it only when its size is under the broadcast threshold)."""
    if isinstance(values, DataFrame):
        vc = values.columns[0]
        return df.join(values.select(F.col(vc).alias("_v")).distinct(), F.col(col) == F.col("_v"), "left_semi")
    return df.where(F.col(col).isin(list(values)))


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))


def count_nulls_in(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows that ``drop_nulls`` would remove (one aggregate)."""
    cond = None
    for c in subset:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.agg(F.count_if(cond).alias("dropped"), F.count(F.lit(1)).alias("rows"))


def impute_mean_mode(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Numeric NULL -> column mean; categorical NULL -> mode (smallest on ties), or
    'Desconocido' when the column has no value at all."""
    from .stats import mode
    fills = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.avg(c).alias(f"_f{i}") for i, c in enumerate(numeric)])
    for i, c in enumerate(categorical):       # one row each: counted values, not a map of them in one task
        fills = fills.crossJoin(mode(df, c).withColumnRenamed("mode", f"_m{i}"))
    j = df.crossJoin(F.broadcast(fills))
    out = []
    for c in df.columns:
        if c in numeric:
            out.append(F.coalesce(F.col(c), F.col(f"_f{list(numeric).index(c)}")).alias(c))
        elif c in categorical:
            out.append(F.coalesce(F.col(c), F.col(f"_m{list(categorical).index(c)}"), F.lit(UNKNOWN)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def impute_median(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """NULL -> median, falling back to mean, then 0 (median of nothing -> mean of
    nothing -> 0). Exact medians come from one radix selection over the stacked columns."""
    from .stats import quantiles
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("_s")
    ).select("_s.*")
    med = quantiles(stacked, "_v", [0.5], ["column"], approx)
    means = df.agg(*[F.avg(c).alias(f"_a{i}") for i, c in enumerate(cols)])
    piv = med.groupBy().pivot("column", list(cols)).agg(F.first("q50"))
    fills = means.crossJoin(piv).select(*[F.coalesce(F.col(f"`{c}`"), F.col(f"_a{i}"), F.lit(0.0)).alias(f"_f{i}")
                                          for i, c in enumerate(cols)])
    j = df.crossJoin(F.broadcast(fills))
    return j.select(*[F.coalesce(F.col(c), F.col(f"_f{list(cols).index(c)}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def null_counts_before_after(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    def counts(df, stage):
        g = df.agg(*[(F.count(F.lit(1)) - F.count(c)).alias(f"_n{i}") for i, c in enumerate(cols)])
        return g.select(F.explode(F.array(*[
            F.struct(F.lit(stage).alias("stage"), F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls"))
            for i, c in enumerate(cols)])).alias("s")).select("s.*")
    return counts(before, "before").unionByName(counts(after, "after"))


def head(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First n rows by an explicit order (TakeOrdered: per-task top n, then merge)."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Last n rows by an explicit order, returned in ascending order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def column_slice(df: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    """Columns by position, half-open like ``iloc`` (plan-time, no scan)."""
    return df.select(*df.columns[start:stop])


def sort_values(df: DataFrame, cols: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Sort with NULLs last in both directions (Spark's ascending default puts them first)."""
    asc = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    return df.orderBy(*[F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(cols, asc)])


def sample_n(df: DataFrame, n: int, key: str | None = None, seed: int = 42) -> DataFrame:
    """n rows chosen uniformly. With ``key`` (a unique integer column) the order is a
    seeded multiplicative hash of the key — the same sample for any partitioning and
    reproducible in SQL; without it, ``rand(seed)`` (depends on the partitioning).
    Either way only n rows per task reach the final merge."""
    if key is not None:
        from .linear import hash_unit
        return df.orderBy(hash_unit(F.col(key) + F.lit(seed)), F.col(key)).limit(n)
    return df.orderBy(F.rand(seed)).limit(n)


def one_hot(df: DataFrame, col: str, levels: Sequence[str] | None = None, drop_first: bool = True) -> DataFrame:
    """0/1 indicator columns ``<col>_<level>`` in sorted level order; the first level is
    dropped when ``drop_first``. Levels come from the caller or from a distinct scan; every
    level is a column of the result, so the driver holds them either way."""
    if levels is None:
        levels = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect()]
    levels = sorted(levels)
    keep = levels[1:] if drop_first else levels
    return df.select("*", *[(F.col(col) == F.lit(v)).cast("int").alias(f"{col}_{v}") for v in keep])


def standardize(fit: DataFrame, cols: Sequence[str], apply_to: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """(x - mean) / population std, parameters fitted on ``fit`` and applied to
    ``apply_to`` (default: ``fit``). Zero std -> scale 1."""
    params = fit.agg(*[F.avg(c).alias(f"_mu{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"_sd{i}") for i, c in enumerate(cols)])
    target = apply_to if apply_to is not None else fit
    j = target.crossJoin(F.broadcast(params))
    out = []
    for c in target.columns:
        if c in cols:
            i = list(cols).index(c)
            sd = F.when(F.col(f"_sd{i}") == 0, F.lit(1.0)).otherwise(F.col(f"_sd{i}"))
            out.append(((F.col(c) - F.col(f"_mu{i}")) / sd).alias(c + suffix))
            if suffix:
                out.append(F.col(c))
        else:
            out.append(F.col(c))
    return j.select(*out)
