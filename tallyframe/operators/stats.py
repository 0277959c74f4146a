"""Descriptive statistics, distributions and outlier rules.

Design: every statistic is a built-in aggregate evaluated in ONE wide ``agg`` per
input (partial aggregation map-side, so hot groups cost nothing extra), then reshaped
long with ``explode(array(struct ...))`` — never one job per column. Scalars needed by
a second pass (means, quartiles) travel as a one-row-per-group aggregate joined back on
the group key (a broadcastable, bounded table), never through ``collect``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import band_desc, safe_div
from ..functions.mathx import norm_cdf, norm_ppf
from .ranks import group_positions
from .selection import radix_quantiles


def _long(df: DataFrame, keys: list[str], cols: list[str], fields: dict[str, callable]) -> DataFrame:
    """One wide aggregate over ``cols`` then one output row per column."""
    aggs = []
    for i, c in enumerate(cols):
        for fname, fn in fields.items():
            aggs.append(fn(F.col(c)).alias(f"_{i}_{fname}"))
    g = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}_{f}").cast("double").alias(f) for f in fields])
        for i, c in enumerate(cols)])).alias("_s")
    return g.select(*keys, rows).select(*keys, "_s.*")


def summary(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """count, sum, mean, sample std / var, min, max, median per column (and group)."""
    keys = list(keys)
    mom = _long(df, keys, cols, {"count": F.count, "sum": F.sum, "mean": F.avg, "std": F.stddev_samp,
                                 "var": F.var_samp, "min": F.min, "max": F.max})
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("_s")
    ).select(*keys, "_s.*")
    med = quantiles(stacked, "_v", [0.5], [*keys, "column"]).withColumnRenamed("q50", "median")
    return mom.join(med, [*keys, "column"], "left")


def describe(df: DataFrame, cols: list[str], keys: list[str] = (), approx: bool = False) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per column (long form). Moments come
    from one wide aggregate; exact quartiles from one radix selection over all
    columns at once (the columns are stacked long and selected within (group, column))."""
    keys = list(keys)
    mom = _long(df, keys, cols, {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min,
                                 "max": F.max})
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("_s")
    ).select(*keys, "_s.*")
    q = quantiles(stacked, "_v", [0.25, 0.5, 0.75], [*keys, "column"], approx)
    return mom.join(q, [*keys, "column"], "left").select(*keys, "column", "count", "mean", "std", "min",
                                                         "q25", "q50", "q75", "max")


def describe_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per string column: non-null count, distinct count, most frequent value (smallest
    on ties) and its frequency. One shuffle for all columns: (column, value) pairs."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("p")
    ).select("p.*").where(F.col("value").isNotNull())
    vc = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
    return vc.groupBy("column").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(F.struct(F.col("value")), F.struct(-F.col("freq"), F.col("value")))["value"].alias("top"),
        F.max("freq").alias("freq"))


def profile(df: DataFrame, cols: list[str] | None = None, approx_distinct: bool = False) -> DataFrame:
    """Per column: type, non-null, null count, null %, distinct count."""
    cols = cols or df.columns
    types = dict(df.dtypes)
    nd = (lambda c: F.approx_count_distinct(c)) if approx_distinct else (lambda c: F.count_distinct(c))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(c)).alias(f"_{i}_nn"), nd(F.col(c)).alias(f"_{i}_nd")]
    g = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 F.col(f"_{i}_nn").alias("non_null"), (F.col("_rows") - F.col(f"_{i}_nn")).alias("nulls"),
                 F.col(f"_{i}_nd").alias("distinct"))
        for i, c in enumerate(cols)])).alias("_s")
    out = g.select("_rows", rows).select("_rows", "_s.*")
    return out.withColumn("null_pct", safe_div(F.col("nulls") * 100.0, F.col("_rows"))).drop("_rows")


def dtype_counts(df: DataFrame) -> DataFrame:
    """Columns per data type (schema only, no scan)."""
    from collections import Counter
    c = Counter(t for _, t in df.dtypes)
    return df.sparkSession.createDataFrame(sorted(c.items()), "dtype string, columns long")


def group_agg(df: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Multi-aggregate group-by with named outputs; rows with a NULL key are dropped
    (as a pandas group-by does)."""
    keep = df
    for k in keys:
        keep = keep.where(F.col(k).isNotNull())
    return keep.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def value_counts(df: DataFrame, col: str, keys: list[str] = ()) -> DataFrame:
    """Frequency of each non-null value and its share % of the (group's) non-null rows.
    The total comes from the counts themselves, joined on the group key."""
    keys = list(keys)
    vc = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("count"))
    tot = vc.groupBy(*keys).agg(F.sum("count").alias("_tot")) if keys else vc.agg(F.sum("count").alias("_tot"))
    j = vc.join(tot, keys) if keys else vc.crossJoin(F.broadcast(tot))  # one row: bounded
    return j.withColumn("share_pct", F.col("count") * 100.0 / F.col("_tot")).drop("_tot")


def mode(df: DataFrame, col: str, keys: list[str] = ()) -> DataFrame:
    """Most frequent non-null value per group; the smallest value wins ties. Two partial
    aggregates (value counts, then ``min_by`` over (-count, value)) instead of one
    value -> count map per group."""
    keys = list(keys)
    vc = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    pick = F.min_by(F.col(col), F.struct(-F.col("_c"), F.col(col))).alias("mode")
    return vc.groupBy(*keys).agg(pick) if keys else vc.agg(pick)


def quantiles(df: DataFrame, col: str, probs: list[float], keys: list[str] = (),
              approx: bool = False) -> DataFrame:
    """Quantiles with linear interpolation as ``qNN`` columns: exact by radix selection
    (bounded memory for any group size), or ``percentile_approx`` with ``approx=True``."""
    keys = list(keys)
    names = [f"q{int(round(p * 100)):02d}" for p in probs]
    if not approx:
        return radix_quantiles(df, col, list(probs), keys, names)
    aggs = [F.percentile_approx(col, p, 10000).alias(nm) for p, nm in zip(probs, names)]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def shape(df: DataFrame, col: str, keys: list[str] = ()) -> DataFrame:
    """n, mean, median, sample std, bias-corrected skewness and excess kurtosis, range,
    coefficient of variation %, and a skew direction label."""
    keys = list(keys)
    g = df.where(F.col(col).isNotNull())
    aggs = [F.count(col).alias("n"), F.avg(col).alias("mean"),
            F.stddev_samp(col).alias("std"), F.skewness(col).alias("_g1"), F.kurtosis(col).alias("_g2"),
            (F.max(col) - F.min(col)).alias("range")]
    a = g.groupBy(*keys).agg(*aggs) if keys else g.agg(*aggs)
    med = quantiles(g, col, [0.5], keys).withColumnRenamed("q50", "median")
    a = a.join(med, keys) if keys else a.crossJoin(med)
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6))
    a = a.withColumn("skewness", skew).withColumn("kurtosis", kurt).drop("_g1", "_g2")
    a = a.withColumn("cv_pct", safe_div(F.col("std"), F.col("mean")) * 100)
    direction = (F.when(F.col("skewness").isNull(), None)
                 .when(F.abs("skewness") < 0.5, "simetrica")
                 .when(F.col("skewness") > 0, "sesgo derecha").otherwise("sesgo izquierda"))
    tail = F.when(F.col("mean") > F.col("median"), "derecha").otherwise("izquierda")
    return a.withColumn("skew_direction", direction).withColumn("mean_vs_median", tail)


# Fixed values: |r| strength bands (strict upper bounds) and labels.
CORR_BANDS = [(0.3, "debil"), (0.7, "moderada")]
CORR_TOP = "fuerte"


def corr_strength(r: Column) -> Column:
    a = F.abs(r)
    return (F.when(r.isNull(), None).when(a < CORR_BANDS[0][0], CORR_BANDS[0][1])
            .when(a < CORR_BANDS[1][0], CORR_BANDS[1][1]).otherwise(CORR_TOP))


def corr_pair(df: DataFrame, a: str, b: str, keys: list[str] = ()) -> DataFrame:
    keys = list(keys)
    agg = [F.corr(a, b).alias("r"), F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias("n")]
    g = df.groupBy(*keys).agg(*agg) if keys else df.agg(*agg)
    return g.withColumn("strength", corr_strength(F.col("r")))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """All k(k-1)/2 Pearson correlations in one pass, long form (i < j) plus the unit
    diagonal."""
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    g = df.agg(*[F.corr(x, y).alias(f"_{i}") for i, (x, y) in enumerate(pairs)])
    rows = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"_{i}").alias("r"))
            for i, (x, y) in enumerate(pairs)]
    rows += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in cols]
    return g.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


# ---- histograms ----------------------------------------------------------------------

def _bin_expr(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1..bins equal-width bin; the maximum folds into the last bin; a degenerate range
    (lo == hi) puts everything in bin 1."""
    b = F.when(hi == lo, F.lit(1)).otherwise(F.floor((v - lo) / (hi - lo) * bins).cast("int") + 1)
    return F.least(b, F.lit(bins))


def histogram(df: DataFrame, col: str, bins: int, keys: list[str] = ()) -> DataFrame:
    """Equal-width histogram over [min, max] per group with empty bins present:
    ``bin, lo, hi, count, density (count / (N * width)), cum_count``."""
    keys = list(keys)
    v = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("_v"))
    rng = v.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                               F.count(F.lit(1)).alias("_N")) if keys else \
        v.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_N"))
    # per-group range is one row per group: joined back (bounded by the number of groups)
    tagged = (v.join(rng, keys) if keys else v.crossJoin(F.broadcast(rng)))
    counts = tagged.groupBy(*keys, _bin_expr(F.col("_v"), F.col("_lo"), F.col("_hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("_c"))
    spine = rng.select(*keys, "_lo", "_hi", "_N", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    h = spine.join(counts, [*keys, "bin"], "left")
    width = (F.col("_hi") - F.col("_lo")) / bins
    h = h.select(*keys, "bin", (F.col("_lo") + (F.col("bin") - 1) * width).alias("lo"),
                 (F.col("_lo") + F.col("bin") * width).alias("hi"),
                 F.coalesce(F.col("_c"), F.lit(0)).cast("long").alias("count"), "_N", width.alias("_w"))
    h = h.withColumn("density", safe_div(F.col("count"), F.col("_N") * F.col("_w")))
    w = Window.partitionBy(*keys).orderBy("bin") if keys else Window.orderBy("bin")  # bins rows per group
    return h.withColumn("cum_count", F.sum("count").over(w)).drop("_N", "_w")


def signed_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Two samples (positive and negative values; zero in neither) on shared bin edges
    taken from both samples together."""
    v = df.where(F.col(col).isNotNull() & (F.col(col) != 0)).select(F.col(col).cast("double").alias("_v"))
    rng = v.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    t = v.crossJoin(F.broadcast(rng)).select(
        F.when(F.col("_v") > 0, "positive").otherwise("negative").alias("sign"),
        _bin_expr(F.col("_v"), F.col("_lo"), F.col("_hi"), bins).alias("bin"))
    counts = t.groupBy("sign", "bin").agg(F.count(F.lit(1)).alias("_c"))
    spine = rng.select("_lo", "_hi", F.explode(F.array(F.lit("positive"), F.lit("negative"))).alias("sign")) \
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return spine.join(counts, ["sign", "bin"], "left").select(
        "sign", "bin", (F.col("_lo") + (F.col("bin") - 1) * width).alias("lo"),
        (F.col("_lo") + F.col("bin") * width).alias("hi"),
        F.coalesce(F.col("_c"), F.lit(0)).cast("long").alias("count"))


def kde(df: DataFrame, col: str, points: int = 100, keys: list[str] = ()) -> DataFrame:
    """Gaussian kernel density on ``points`` grid points spanning [min, max] per group,
    bandwidth ``n^(-1/5) * sample std`` (Scott). Identical values are pre-aggregated to
    (value, weight) rows first; every such row adds to ``points`` partial sums, so no
    (value, point) rows are made and a group shuffles one row per task. Null keys form a group."""
    keys = list(keys)
    base = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("_x"))
    v = base.groupBy(*keys, F.col("_x").alias("_v")).agg(F.count(F.lit(1)).alias("_w"))
    wsum = lambda e: F.sum(e * F.col("_w"))
    st = v.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_w").alias("_n"),
                              wsum(F.col("_v")).alias("_s1"), wsum(F.col("_v") ** 2).alias("_s2")) if keys else \
        v.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_w").alias("_n"),
              wsum(F.col("_v")).alias("_s1"), wsum(F.col("_v") ** 2).alias("_s2"))
    return _kde_on_weights(v, st, keys, points)


def _kde_on_weights(v: DataFrame, st: DataFrame, keys: list[str], points: int) -> DataFrame:
    """Density on the grid from (value, weight) rows and per-group range / moments."""
    n = F.col("_n").cast("double")
    std = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("_s2") - F.col("_s1") ** 2 / n, n - 1)))
    st = st.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_lo", "_hi", "_n",
                   (F.pow(n, -0.2) * std).alias("_h"))
    # one row of range and bandwidth per group
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]
    j = v.join(st, same) if keys else v.crossJoin(F.broadcast(st))
    at = lambda p: F.col("_lo") + (F.col("_hi") - F.col("_lo")) * p / (points - 1)
    kernel = lambda p: F.exp(-0.5 * F.try_divide(at(F.lit(p)) - F.col("_v"), F.col("_h")) ** 2)
    sums = j.groupBy(*keys, "_lo", "_hi", "_n", "_h").agg(
        *[F.sum(kernel(p) * F.col("_w")).alias(f"_s{p}") for p in range(points)])
    out = sums.select(*keys, "_lo", "_hi", "_n", "_h",
                      F.posexplode(F.array(*[f"_s{p}" for p in range(points)])).alias("point", "_sum"))
    density = F.try_divide(F.col("_sum"), F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))
    return out.select(*keys, "point", at(F.col("point")).alias("x"), density.alias("density"))


def normal_curve(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """N(mean, sample std) density on a grid over [min, max]."""
    st = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"), F.avg(col).alias("_m"),
                F.stddev_samp(col).alias("_s"))
    g = st.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("point") / (points - 1)
    g = g.withColumn("x", x)
    pdf = F.try_divide(F.exp(-0.5 * F.try_divide(F.col("x") - F.col("_m"), F.col("_s")) ** 2), F.col("_s") * math.sqrt(2 * math.pi))
    return g.select("point", "x", pdf.alias("density"))


# ---- outliers and box plots ----------------------------------------------------------

def box_stats(df: DataFrame, col: str, keys: list[str] = (), approx: bool = False) -> DataFrame:
    """Q1, median, Q3, IQR, whiskers (furthest values within 1.5 IQR of the box) and
    outlier count per group. Two passes: quartiles per group, then a join back on the
    group key (one row per group) and conditional min/max."""
    keys = list(keys)
    q = quantiles(df, col, [0.25, 0.5, 0.75], keys, approx).withColumnRenamed("q25", "q1") \
        .withColumnRenamed("q50", "median").withColumnRenamed("q75", "q3")
    v = df.where(F.col(col).isNotNull())
    j = v.join(q, keys) if keys else v.crossJoin(F.broadcast(q))
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    x = F.col(col)
    return j.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(x >= lo_f, x)).alias("whisker_low"), F.max(F.when(x <= hi_f, x)).alias("whisker_high"),
        F.count(F.when((x < lo_f) | (x > hi_f), 1)).alias("outliers"), F.count(x).alias("n")
    ).withColumn("iqr", F.col("q3") - F.col("q1"))


def iqr_outliers(df: DataFrame, col: str, keys: list[str] = ()) -> DataFrame:
    """Rows strictly below Q1 - 1.5 IQR or above Q3 + 1.5 IQR (of their group)."""
    keys = list(keys)
    q = quantiles(df, col, [0.25, 0.75], keys)
    j = df.join(q, keys) if keys else df.crossJoin(F.broadcast(q))
    iqr = F.col("q75") - F.col("q25")
    return j.where((F.col(col) < F.col("q25") - 1.5 * iqr) | (F.col(col) > F.col("q75") + 1.5 * iqr)) \
        .drop("q25", "q75")


def above_mean_std(df: DataFrame, col: str, k: float = 1.0) -> DataFrame:
    """Rows with value > mean + k * sample std."""
    st = df.agg((F.avg(col) + k * F.stddev_samp(col)).alias("_cut"))
    return df.crossJoin(F.broadcast(st)).where(F.col(col) > F.col("_cut")).drop("_cut")


def return_stats(df: DataFrame, ret_col: str, t_col: str, keys: list[str] = ()) -> DataFrame:
    """Positive / negative day counts and %, annualised volatility (std * sqrt 252),
    best and worst day with their dates (the earliest of equal ones). Null returns count nowhere."""
    keys = list(keys)
    r = F.col(ret_col)
    t = F.col(t_col)
    aggs = [F.count(r).alias("days"), F.count_if(r > 0).alias("positive_days"),
            F.count_if(r < 0).alias("negative_days"),
            (F.stddev_samp(r) * math.sqrt(252)).alias("volatility_annual"),
            F.max(r).alias("best_return"), F.min_by(t, F.when(r.isNotNull(), F.struct(-r, t))).alias("best_day"),
            F.min(r).alias("worst_return"), F.min_by(t, F.when(r.isNotNull(), F.struct(r, t))).alias("worst_day")]
    g = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return (g.withColumn("positive_pct", safe_div(F.col("positive_days") * 100.0, F.col("days")))
             .withColumn("negative_pct", safe_div(F.col("negative_days") * 100.0, F.col("days"))))


def group_contrast(df: DataFrame, key: str, col: str, threshold: float = 2.0) -> DataFrame:
    """|mean of first group - mean of second group| (groups in key order) and whether it
    exceeds ``threshold``. Works on the per-group aggregate (one row per group)."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.count(col).alias("count"))
    first = g.agg(F.min(key).alias("group_a"))
    second = g.crossJoin(F.broadcast(first)).where(F.col(key) > F.col("group_a")).agg(
        F.min(key).alias("group_b"))
    pair = first.crossJoin(second)  # one row
    ma = g.select(F.col(key).alias("group_a"), F.col("mean").alias("_ma"))
    mb = g.select(F.col(key).alias("group_b"), F.col("mean").alias("_mb"))
    d = pair.join(ma, "group_a").join(mb, "group_b").select(
        "group_a", "group_b", F.abs(F.col("_ma") - F.col("_mb")).alias("difference"))
    return d.withColumn("notable", F.col("difference") > threshold)


# ---- normality -----------------------------------------------------------------------

def qq_points(df: DataFrame, col: str, keys: list[str] = ()) -> DataFrame:
    """Ordered values against normal quantiles at Filliben plotting positions, with the
    least-squares fit line (slope, intercept, r) of the group."""
    keys = list(keys)
    v = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("value"))
    p = group_positions(v, keys, "value", "pos", "n")
    i, n = F.col("pos").cast("double"), F.col("n").cast("double")
    m = (F.when(F.col("pos") == 1, 1 - F.pow(F.lit(0.5), 1 / n))
         .when(F.col("pos") == F.col("n"), F.pow(F.lit(0.5), 1 / n))
         .otherwise((i - 0.3175) / (n + 0.365)))
    p = p.withColumn("_m", m)
    p = p.withColumn("theoretical", norm_ppf("_m")).drop("_m")
    fit = p.groupBy(*keys).agg(F.regr_slope("value", "theoretical").alias("slope"),
                               F.regr_intercept("value", "theoretical").alias("intercept"),
                               F.corr("value", "theoretical").alias("r")) if keys else \
        p.agg(F.regr_slope("value", "theoretical").alias("slope"),
              F.regr_intercept("value", "theoretical").alias("intercept"),
              F.corr("value", "theoretical").alias("r"))
    return p.join(fit, keys) if keys else p.crossJoin(F.broadcast(fit))


def shapiro_wilk(df: DataFrame, col: str, keys: list[str] = (), alpha: float = 0.05) -> DataFrame:
    """Shapiro-Wilk W and p-value per group by Royston's (1992/1995) approximation,
    valid for 4 <= n <= 5000; verdict 'normal' when p > alpha."""
    keys = list(keys)
    v = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("x"))
    p = group_positions(v, keys, "x", "pos", "n")
    i, n = F.col("pos").cast("double"), F.col("n").cast("double")
    p = p.withColumn("_pp", (i - 0.375) / (n + 0.25)).withColumn("m", norm_ppf("_pp"))
    g = p.groupBy(*keys).agg(F.sum(F.col("m") ** 2).alias("mm"), F.first("n").alias("n"),
                             F.avg("x").alias("mean")) if keys else \
        p.agg(F.sum(F.col("m") ** 2).alias("mm"), F.first("n").alias("n"), F.avg("x").alias("mean"))
    nn = F.col("n").cast("double")
    u = 1 / F.sqrt(nn)
    g = (g.withColumn("_pn", (nn - 0.375) / (nn + 0.25)).withColumn("mn", norm_ppf("_pn"))
          .withColumn("_pn1", (nn - 1 - 0.375) / (nn + 0.25)).withColumn("mn1", norm_ppf("_pn1")))
    cn, cn1 = F.col("mn") / F.sqrt("mm"), F.col("mn1") / F.sqrt("mm")
    an = cn + 0.221157 * u - 0.147981 * u ** 2 - 2.071190 * u ** 3 + 4.434685 * u ** 4 - 2.706056 * u ** 5
    an1 = cn1 + 0.042981 * u - 0.293762 * u ** 2 - 1.752461 * u ** 3 + 5.682633 * u ** 4 - 3.582633 * u ** 5
    g = g.withColumn("an", an).withColumn("an1", F.when(nn > 5, an1).otherwise(F.lit(None)))
    eps = F.when(nn > 5, (F.col("mm") - 2 * F.col("mn") ** 2 - 2 * F.col("mn1") ** 2)
                 / (1 - 2 * F.col("an") ** 2 - 2 * F.col("an1") ** 2)) \
        .otherwise((F.col("mm") - 2 * F.col("mn") ** 2) / (1 - 2 * F.col("an") ** 2))
    g = g.withColumn("eps", eps).drop("_pn", "_pn1")
    j = p.join(g.select(*keys, "an", "an1", "eps", "mean"), keys) if keys else \
        p.crossJoin(F.broadcast(g.select("an", "an1", "eps", "mean")))
    pos, nrow = F.col("pos"), F.col("n")
    a = (F.when(pos == nrow, F.col("an")).when(pos == 1, -F.col("an"))
         .when((pos == nrow - 1) & F.col("an1").isNotNull(), F.col("an1"))
         .when((pos == 2) & F.col("an1").isNotNull(), -F.col("an1"))
         .otherwise(F.col("m") / F.sqrt("eps")))
    s = j.groupBy(*keys).agg(F.sum(a * F.col("x")).alias("_num"),
                             F.sum((F.col("x") - F.col("mean")) ** 2).alias("_ss"),
                             F.first("n").alias("n")) if keys else \
        j.agg(F.sum(a * F.col("x")).alias("_num"), F.sum((F.col("x") - F.col("mean")) ** 2).alias("_ss"),
              F.first("n").alias("n"))
    w = F.least(F.lit(1.0), F.try_divide(F.col("_num") ** 2, F.col("_ss")))
    s = s.withColumn("W", w)
    nn = F.col("n").cast("double")
    ln_n = F.log(nn)
    mu_big = 0.0038915 * ln_n ** 3 - 0.083751 * ln_n ** 2 - 0.31082 * ln_n - 1.5861
    sg_big = F.exp(0.0030302 * ln_n ** 2 - 0.082676 * ln_n - 0.4803)
    gamma = 0.459 * nn - 2.273
    mu_small = -0.0006714 * nn ** 3 + 0.025054 * nn ** 2 - 0.39978 * nn + 0.5440
    sg_small = F.exp(-0.0020322 * nn ** 3 + 0.062767 * nn ** 2 - 0.77857 * nn + 1.3822)
    z = F.when(nn >= 12, (F.log(1 - F.col("W")) - mu_big) / sg_big) \
        .otherwise((-F.log(gamma - F.log(1 - F.col("W"))) - mu_small) / sg_small)
    s = s.withColumn("_z", z).withColumn("p_value", 1 - norm_cdf("_z"))
    s = s.withColumn("p_value", F.when(F.col("n") < 4, None).otherwise(F.col("p_value")))
    verdict = F.when(F.col("p_value").isNull(), None).when(F.col("p_value") > alpha, "normal").otherwise("no normal")
    return s.select(*keys, "n", "W", "p_value", verdict.alias("verdict"))


def label_r2(r2: Column) -> Column:
    """Fit strength: > .7 strong, > .4 moderate, else weak."""
    return band_desc(r2, [(0.7, False, "fuerte"), (0.4, False, "moderado")], "debil")
