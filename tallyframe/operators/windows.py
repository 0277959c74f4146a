"""Ordered-series functions. Every window is partitioned by the series keys and ordered by
an explicit time column (Spark rows have no inherent order).

Series here are period series (a row per entity and day / month, produced by a
``groupBy`` first), so a window partition holds at most the periods an entity spans.
Ungrouped top-k uses ``orderBy().limit()`` (per-task top-k, then a merge); grouped
top-k is a ``row_number() <= k`` window that Spark plans with a partial
``WindowGroupLimit`` before the shuffle, so a hot group is trimmed on every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import safe_div


def _w(keys, t):
    keys = list(keys)
    return (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(t)


def diff(df: DataFrame, v: str, t: str, keys=(), out: str = "diff", lag: int = 1) -> DataFrame:
    return df.withColumn(out, F.col(v) - F.lag(v, lag).over(_w(keys, t)))


def pct_change(df: DataFrame, v: str, t: str, keys=(), out: str = "pct_change") -> DataFrame:
    """(v / previous v - 1) * 100; NULL on the first row and when the previous is 0."""
    return df.withColumn(out, (safe_div(F.col(v), F.lag(v).over(_w(keys, t))) - 1) * 100)


def cumulative_return(df: DataFrame, r: str, t: str, keys=(), out: str = "cum_return",
                      percent: bool = True) -> DataFrame:
    """Running product of (1 + r) (r in percent when ``percent``); a NULL first return
    stays NULL, later products skip it as pandas ``cumprod`` does."""
    rr = F.col(r) / 100 if percent else F.col(r)
    w = _w(keys, t).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.when(F.col(r).isNotNull(), F.product(1 + rr).over(w)))


def rolling(df: DataFrame, v: str, t: str, n: int, keys=(), mean_out: str = "rolling_mean",
            std_out: str = "rolling_std") -> DataFrame:
    """Trailing n-row mean and sample std; NULL until the window holds n values."""
    w = _w(keys, t).rowsBetween(-(n - 1), 0)
    full = F.count(v).over(w) == n
    return (df.withColumn(mean_out, F.when(full, F.avg(v).over(w)))
              .withColumn(std_out, F.when(full, F.stddev_samp(v).over(w))))


def running_sum(df: DataFrame, v: str, t: str, keys=(), out: str = "running_sum") -> DataFrame:
    w = _w(keys, t).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(v).over(w))


def undo_diff(df: DataFrame, d: str, t: str, base: Column, keys=(), out: str = "level") -> DataFrame:
    """Level = base (last observed level) + running sum of differences."""
    w = _w(keys, t).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, base + F.sum(d).over(w))


def ffill_bfill(df: DataFrame, cols: list[str], t: str, keys=()) -> DataFrame:
    """Forward fill, then back fill the leading gap."""
    base = _w(keys, t)
    back = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = base.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(back),
                                         F.first(c, ignorenulls=True).over(fwd)))
    return df


def hold_last(df: DataFrame, keys: list[str], t: str, horizon: int, overrides: dict | None = None) -> DataFrame:
    """Carry each series' last row into ``horizon`` future steps (step 1..h), optionally
    overriding columns with constants. One aggregate row per series, then explode."""
    others = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(t)).alias("_last"))
    out = last.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "_last.*")
    for c, v in (overrides or {}).items():
        out = out.withColumn(c, F.lit(v))
    return out


def argmax_row(df: DataFrame, v: str, tie: str, keys=(), smallest: bool = False) -> DataFrame:
    """The row with the largest (or smallest) ``v`` per group; ties -> smallest ``tie``
    (of any type that sorts); null values come last. One aggregate, no sort."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(v).isNull(), F.col(v) if smallest else -F.col(v), F.col(tie))
    agg = F.min_by(F.struct(*others), order).alias("_r")
    g = df.groupBy(*keys).agg(agg) if keys else df.agg(agg)
    return g.select(*keys, "_r.*")


def top_k(df: DataFrame, v: str, k: int, keys=(), tie: str | None = None, desc: bool = True) -> DataFrame:
    """Top-k rows by ``v`` (per group), ties by ``tie`` ascending; adds ``rank``.

    Ungrouped: ``orderBy().limit()`` (per-task top-k, then a merge). Grouped: a
    ``row_number() <= k`` window, which the optimizer turns into a partial
    ``WindowGroupLimit`` before the shuffle — each task ships at most k rows per group,
    so a hot group is cut down map-side."""
    keys = list(keys)
    o = F.col(v).desc() if desc else F.col(v).asc()
    order = [o] + ([F.col(tie).asc()] if tie else [])
    if not keys:
        return df.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def autocorr(df: DataFrame, v: str, t: str, keys=(), max_lag: int = 10) -> DataFrame:
    """Normalised lag products sum(v_t * v_{t-k}) / sum(v_t^2), k = 1..min(max_lag, n-1)
    (not mean-centred). Lags come from one window pass, sums from one aggregate."""
    keys = list(keys)
    w = _w(keys, t)
    x = df.select(*keys, F.col(v).cast("double").alias("_v"),
                  *[F.lag(v, k).over(w).alias(f"_l{k}") for k in range(1, max_lag + 1)])
    aggs = [F.sum(F.col("_v") ** 2).alias("_ss"), F.count("_v").alias("_n")]
    aggs += [F.sum(F.col("_v") * F.col(f"_l{k}")).alias(f"_p{k}") for k in range(1, max_lag + 1)]
    g = x.groupBy(*keys).agg(*aggs) if keys else x.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_p{k}"), F.col("_ss")).alias("acf"))
                               for k in range(1, max_lag + 1)])).alias("_s")
    out = g.select(*keys, "_n", rows).select(*keys, "_n", "_s.*")
    return out.where(F.col("lag") <= F.col("_n") - 1).drop("_n")
