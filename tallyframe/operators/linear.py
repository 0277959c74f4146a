"""Linear models from Gram aggregates.

The heavy part of every fit (OLS, ridge, ridge CV, VIF, polynomial trend, Fourier
trend, Dickey-Fuller, Hannan-Rissanen) is ONE Spark aggregate per (series, block):
the cross products of ``v = [1, x_1..x_p, y]`` — (p+2)(p+3)/2 sums, built map-side
by partial aggregation, so a hot series costs one partial row per task. Values are
shifted by a per-series mean first (one small aggregate joined on the series key) to
keep the sums well conditioned.

The p x p algebra then runs per series in ``applyInPandas`` over that series' few Gram
rows (one per block), never over data rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import group_positions


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solution of a x = b; the minimum-norm one where ``a`` is singular, so one degenerate
    series does not end the job of all others."""
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(a, b, rcond=None)[0]



# ---- Gram aggregation ----------------------------------------------------------------

def _pairs(p: int):
    return [(i, j) for i in range(p) for j in range(i, p)]


def gram(df: DataFrame, keys: Sequence[str], xcols: Sequence[str], y: str,
         block: Column | None = None, shift: bool = True) -> DataFrame:
    """Per (keys, block): ``n`` and the upper-triangle cross products of
    ``[1, x.., y]`` (after subtracting the per-series mean when ``shift``), plus the
    shift vector. Rows with a NULL in x or y are skipped."""
    keys = list(keys)
    cols = list(xcols) + [y]
    d = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols],
                  *([block.alias("_block")] if block is not None else [F.lit(0).alias("_block")]))
    d = d.na.drop(subset=cols)
    if shift:
        mu = d.groupBy(*keys).agg(*[F.avg(c).alias(f"_mu_{i}") for i, c in enumerate(cols)]) if keys else \
            d.agg(*[F.avg(c).alias(f"_mu_{i}") for i, c in enumerate(cols)])
        d = d.join(mu, keys) if keys else d.crossJoin(F.broadcast(mu))
    else:
        d = d.select("*", *[F.lit(0.0).alias(f"_mu_{i}") for i in range(len(cols))])
    v = [F.lit(1.0)] + [F.col(c) - F.col(f"_mu_{i}") for i, c in enumerate(cols)]
    aggs = [F.sum(v[i] * v[j]).alias(f"g_{i}_{j}") for i, j in _pairs(len(v))]
    aggs += [F.first(f"_mu_{i}").alias(f"mu_{i}") for i in range(len(cols))]
    return d.groupBy(*keys, "_block").agg(*aggs).withColumnRenamed("_block", "block")


def gram_matrix(row, k: int) -> np.ndarray:
    """Rebuild the full (k x k) symmetric matrix from a Gram row (pandas Series)."""
    m = np.zeros((k, k))
    for i, j in _pairs(k):
        m[i, j] = m[j, i] = row[f"g_{i}_{j}"]
    return m


# ---- ridge / OLS algebra on a Gram --------------------------------------------------

def ridge_from_gram(G: np.ndarray, alpha: float, scale: np.ndarray | None = None):
    """Ridge with unpenalised intercept from the Gram of ``[1, x, y]``.

    ``scale`` (length p) divides features before the penalty is applied (standardised
    ridge); coefficients are returned in the (shifted) input units.
    Returns (intercept, coef, n).
    """
    n = G[0, 0]
    p = G.shape[0] - 2
    sx, sy = G[0, 1:p + 1], G[0, p + 1]
    mx, my = sx / n, sy / n
    Sxx = G[1:p + 1, 1:p + 1] - n * np.outer(mx, mx)
    Sxy = G[1:p + 1, p + 1] - n * mx * my
    s = np.ones(p) if scale is None else np.where(scale == 0, 1.0, scale)
    Zxx = Sxx / np.outer(s, s)
    Zxy = Sxy / s
    beta_z = solve(Zxx + alpha * np.eye(p), Zxy) if p else np.zeros(0)
    coef = beta_z / s
    return my - coef @ mx, coef, n


def sse_from_gram(G: np.ndarray, intercept: float, coef: np.ndarray) -> float:
    """Sum of squared errors of ``y - intercept - x coef`` over the rows of a Gram."""
    w = np.concatenate([[-intercept], -coef, [1.0]])
    return float(w @ G @ w)


def pop_std_from_gram(G: np.ndarray) -> np.ndarray:
    n = G[0, 0]
    p = G.shape[0] - 2
    m = G[0, 1:p + 1] / n
    var = np.diag(G)[1:p + 1] / n - m ** 2
    return np.sqrt(np.maximum(var, 0.0))


def explained_variance(G: np.ndarray, intercept: float, coef: np.ndarray) -> float:
    """1 - var_pop(residual) / var_pop(y), from the Gram alone."""
    n = G[0, 0]
    p = G.shape[0] - 2
    w = np.concatenate([[-intercept], -coef, [1.0]])
    r_sum = float(G[0] @ w)
    r_ss = float(w @ G @ w)
    var_r = r_ss / n - (r_sum / n) ** 2
    var_y = G[p + 1, p + 1] / n - (G[0, p + 1] / n) ** 2
    return 1.0 - var_r / var_y if var_y > 0 else float("nan")


# ---- public operators ---------------------------------------------------------------

def ols_simple(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept, R^2 (built-in regression aggregates) and residual mean / std /
    min / max (second pass joined on the group key)."""
    keys = list(keys)
    fit_aggs = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")]
    fit = df.groupBy(*keys).agg(*fit_aggs) if keys else df.agg(*fit_aggs)
    j = df.join(fit, keys) if keys else df.crossJoin(F.broadcast(fit))
    res = F.col(y) - (F.col("intercept") + F.col("slope") * F.col(x))
    r_aggs = [F.avg(res).alias("resid_mean"), F.stddev_samp(res).alias("resid_std"),
              F.min(res).alias("resid_min"), F.max(res).alias("resid_max")]
    r = j.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    r = r.groupBy(*keys).agg(*r_aggs) if keys else r.agg(*r_aggs)
    return fit.join(r, keys) if keys else fit.crossJoin(r)


def _apply(g: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """Per-series Python step over the (few) Gram rows of each series."""
    if keys:
        return g.groupBy(*keys).applyInPandas(fn, schema)

    def wrapped(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fn(pdf)
        out.insert(0, "_all", 0)
        return out
    return g.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(wrapped, "_all int, " + schema).drop("_all")


def _key_schema(df: DataFrame, keys: list[str]) -> str:
    t = dict(df.dtypes)
    return ", ".join(f"{k} {t[k]}" for k in keys)


def ridge_fit(df: DataFrame, y: str, xcols: Sequence[str], keys: Sequence[str] = (), alpha: float = 1.0,
              standardize: Sequence[str] | None = None) -> DataFrame:
    """Ridge per series: features in ``standardize`` (default: all) are scaled by their
    population std before the L2 penalty; the intercept is not penalised.
    Output: keys, n, alpha, intercept, coef (array, input order), explained_variance."""
    keys, xcols = list(keys), list(xcols)
    std_set = set(xcols if standardize is None else standardize)
    g = gram(df, keys, xcols, y)
    p = len(xcols)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        G = sum(gram_matrix(r, p + 2) for _, r in pdf.iterrows())
        sd = pop_std_from_gram(G)
        scale = np.array([sd[i] if c in std_set else 1.0 for i, c in enumerate(xcols)])
        b0, coef, n = ridge_from_gram(G, alpha, scale)
        ev = explained_variance(G, b0, coef)
        mu = np.array([pdf.iloc[0][f"mu_{i}"] for i in range(p + 1)])
        b0 = b0 + mu[p] - coef @ mu[:p]  # undo the per-series shift
        out = {k: [pdf.iloc[0][k]] for k in keys}
        out.update(n=[int(n)], alpha=[float(alpha)], intercept=[float(b0)], coef=[[float(c) for c in coef]],
                   explained_variance=[ev])
        return pd.DataFrame(out)

    ks = _key_schema(df, keys)
    schema = (ks + ", " if ks else "") + \
        "n long, alpha double, intercept double, coef array<double>, explained_variance double"
    return _apply(g, keys, fit, schema)


def _fold_block(scheme: str, folds: int) -> Column:
    """Block id of a row (1-based ``_pos`` of ``_n``) such that every fold boundary is a
    block boundary. kfold: contiguous near-equal folds (first n mod K one row longer);
    timeseries: block 0 = initial train rows, then s = min(folds, n div 2) test blocks
    of n div (s + 1) rows."""
    r, n = F.col("_pos") - 1, F.col("_n")
    if scheme == "kfold":
        q = F.floor(n / folds)
        rem = n - q * folds
        big = rem * (q + 1)
        return F.when(r < big, F.floor(r / (q + 1))).otherwise(rem + F.floor((r - big) / q)).cast("int")
    s = F.least(F.lit(folds), F.floor(n / 2))
    test = F.floor(n / (s + 1))
    a0 = n - s * test
    return F.when(r < a0, F.lit(0)).otherwise(F.floor((r - a0) / test) + 1).cast("int")


def ridge_cv(df: DataFrame, y: str, xcols: Sequence[str], t: str, keys: Sequence[str] = (),
             alphas: Sequence[float] = tuple(np.logspace(-3, 3, 50)), scheme: str = "kfold",
             folds: int = 5, scoring: str = "neg_mse",
             standardize: Sequence[str] | None = None) -> DataFrame:
    """Alpha search per series in ONE data pass.

    Rows are numbered in ``t`` order (skew-safe positions) and tagged with the fold block
    they fall in; one Gram per (series, block). Any fold's train and test Grams are sums
    of blocks, so every (alpha, fold) fit is p x p algebra on the Python side.
    ``scheme='kfold'``: contiguous K folds (test = one fold, train = the others);
    ``'timeseries'``: expanding window, s = min(folds, n div 2) splits. Features are
    standardised with the population std of all rows (scaler fitted outside the folds,
    as in the reference pipelines); ``standardize`` limits that to the listed columns
    (indicator columns stay 0/1). ``scoring``: 'neg_mse' (mean of -MSE) or 'r2'.
    Output: keys, n, best_alpha, best_score, intercept, coef (refit on all rows),
    explained_variance.
    """
    keys, xcols = list(keys), list(xcols)
    p = len(xcols)
    std_set = set(xcols if standardize is None else standardize)
    pos = group_positions(df.select(*keys, t, *xcols, y).na.drop(subset=[*xcols, y]), keys, t, "_pos", "_n")
    g = gram(pos, keys, xcols, y, block=_fold_block(scheme, folds))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = {int(r["block"]): gram_matrix(r, p + 2) for _, r in pdf.iterrows()}
        G_all = sum(blocks.values())
        n = int(round(G_all[0, 0]))
        sd_all = pop_std_from_gram(G_all)
        sd = np.array([sd_all[i] if c in std_set else 1.0 for i, c in enumerate(xcols)])
        zero = np.zeros_like(G_all)
        if scheme == "kfold":
            splits = [([b for b in blocks if b != k], [k]) for k in sorted(blocks)]
        else:
            splits = [([b for b in blocks if b < k], [k]) for k in sorted(blocks) if k > 0]
        scores = []
        for a in alphas:
            s = []
            for tr, te in splits:
                Gtr = sum((blocks[b] for b in tr), zero)
                Gte = sum((blocks[b] for b in te), zero)
                if Gtr[0, 0] < 1 or Gte[0, 0] < 1:
                    continue
                b0, coef, _ = ridge_from_gram(Gtr, a, sd)
                sse = sse_from_gram(Gte, b0, coef)
                m = Gte[0, 0]
                if scoring == "r2":
                    ym = Gte[0, p + 1] / m
                    sst = Gte[p + 1, p + 1] - m * ym * ym
                    s.append(1 - sse / sst if sst > 0 else float("nan"))
                else:
                    s.append(-sse / m)
            scores.append(np.mean(s) if s else float("nan"))
        scores = np.array(scores, dtype=float)
        best = int(np.nanargmax(scores)) if np.isfinite(scores).any() else 0
        a = float(alphas[best])
        b0, coef, _ = ridge_from_gram(G_all, a, sd)
        ev = explained_variance(G_all, b0, coef)
        mu = np.array([pdf.iloc[0][f"mu_{i}"] for i in range(p + 1)])
        b0u = b0 + mu[p] - coef @ mu[:p]
        out = {k: [pdf.iloc[0][k]] for k in keys}
        out.update(n=[n], best_alpha=[a], best_score=[float(scores[best])], intercept=[float(b0u)],
                   coef=[[float(c) for c in coef]], explained_variance=[ev])
        return pd.DataFrame(out)

    ks = _key_schema(df, keys)
    schema = (ks + ", " if ks else "") + ("n long, best_alpha double, best_score double, intercept double, "
                                          "coef array<double>, explained_variance double")
    return _apply(g, keys, fit, schema)


def ridge_path(df: DataFrame, y: str, xcols: Sequence[str], alphas: DataFrame, keys: Sequence[str] = (),
               alpha_col: str = "alpha") -> DataFrame:
    """Ridge coefficients along an alpha grid (one row per series and alpha), features
    standardised by population std, intercept unpenalised. One Gram per series; the
    grid (a small DataFrame of alphas) is attached to the Gram rows by a broadcast
    cross join, so every (series, alpha) solve reads only that series' Gram."""
    keys, xcols = list(keys), list(xcols)
    p = len(xcols)
    g = gram(df, keys, xcols, y).crossJoin(F.broadcast(alphas.select(F.col(alpha_col).alias("_alpha"))))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for a, part in pdf.groupby("_alpha"):
            G = sum(gram_matrix(r, p + 2) for _, r in part.iterrows())
            sd = pop_std_from_gram(G)
            b0, coef, n = ridge_from_gram(G, float(a), sd)
            mu = np.array([part.iloc[0][f"mu_{i}"] for i in range(p + 1)])
            b0 = b0 + mu[p] - coef @ mu[:p]
            r = {k: part.iloc[0][k] for k in keys}
            r.update(alpha=float(a), intercept=float(b0), coef=[float(c) for c in coef])
            rows.append(r)
        return pd.DataFrame(rows, columns=keys + ["alpha", "intercept", "coef"])

    ks = _key_schema(df, keys)
    schema = (ks + ", " if ks else "") + "alpha double, intercept double, coef array<double>"
    return _apply(g, keys, fit, schema)


def vif(df: DataFrame, xcols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Variance inflation factor per feature = diagonal of the inverse correlation matrix
    (equal to 1 / (1 - R^2_j) of each feature on the others with a constant); > 10 high."""
    keys, xcols = list(keys), list(xcols)
    p = len(xcols)
    g = gram(df, keys, xcols[:-1], xcols[-1])  # y slot used as the last feature

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        G = sum(gram_matrix(r, p + 1) for _, r in pdf.iterrows())
        n = G[0, 0]
        m = G[0, 1:] / n
        S = G[1:, 1:] / n - np.outer(m, m)
        d = np.sqrt(np.diag(S))
        C = S / np.outer(d, d)
        try:
            v = np.diag(np.linalg.inv(C))
        except np.linalg.LinAlgError:
            v = np.full(p, np.inf)
        rows = {k: [pdf.iloc[0][k]] * p for k in keys}
        rows.update(feature=list(xcols), vif=[float(x) for x in v], high=[bool(x > 10) for x in v])
        return pd.DataFrame(rows)

    ks = _key_schema(df, keys)
    schema = (ks + ", " if ks else "") + "feature string, vif double, high boolean"
    return _apply(g, keys, fit, schema)


def poly_trend(df: DataFrame, y: str, t: str, degree: int, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares polynomial of ``degree`` in the (centred, scaled) row index per
    series; returns fitted values per row. Index = position in ``t`` order."""
    keys = list(keys)
    pos = group_positions(df.select(*keys, t, y), keys, t, "_pos", "_n")
    u = (F.col("_pos") - (F.col("_n") + 1) / 2) / F.greatest(F.col("_n") / 2, F.lit(1.0))
    pos = pos.select("*", *[F.pow(u, k).alias(f"_u{k}") for k in range(1, degree + 1)])
    fit = ridge_fit(pos, y, [f"_u{k}" for k in range(1, degree + 1)], keys, alpha=0.0, standardize=[])
    j = pos.join(fit, keys) if keys else pos.crossJoin(F.broadcast(fit))
    yhat = F.col("intercept")
    for k in range(1, degree + 1):
        yhat = yhat + F.col("coef")[k - 1] * F.col(f"_u{k}")
    return j.select(*keys, t, y, F.col("_pos").alias("index"), yhat.alias("trend"))


def regression_metrics(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = ()) -> DataFrame:
    """R^2, MSE, RMSE, MAE, MAPE % in one aggregate (R^2 = 1 - SSE / SST). Rows with y = 0 do
    not count for MAPE; R^2 of a constant y is null."""
    keys = list(keys)
    e = F.col(y) - F.col(yhat)
    d = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
            (F.avg(F.abs(F.try_divide(e, F.col(y)))) * 100).alias("mape"), F.sum(e * e).alias("_sse"),
            F.var_pop(y).alias("_vy")]
    g = d.groupBy(*keys).agg(*aggs) if keys else d.agg(*aggs)
    return g.select(*keys, "n", (1 - F.try_divide(F.col("_sse"), F.col("_vy") * F.col("n"))).alias("r2"), "mse",
                    F.sqrt("mse").alias("rmse"), "mae", "mape")


def forecast_evaluation(scored: DataFrame, y: str, yhat: str, keys: Sequence[str] = ()) -> DataFrame:
    """``regression_metrics`` of forecasts against the actuals that followed, with mean_error, the
    mean relative error (actuals of 0 do not count)."""
    keys = list(keys)
    d = scored.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    error = F.avg(F.try_divide(F.abs(F.col(y) - F.col(yhat)), F.abs(F.col(y)))).alias("mean_error")
    mean = d.groupBy(*keys).agg(error) if keys else d.agg(error)
    m = regression_metrics(scored, y, yhat, keys)
    return m.join(mean, keys) if keys else m.crossJoin(mean)


def temporal_split(df: DataFrame, t: str, keys: Sequence[str] = (), test_size: float = 0.2,
                   min_rows: int = 10) -> DataFrame:
    """Flag the last max(1, int(test_size * n)) rows of each series (when n > min_rows)
    as test. Positions come from ``group_positions``."""
    keys = list(keys)
    p = group_positions(df, keys, t, "_pos", "_n")
    n_test = F.greatest(F.lit(1), F.floor(F.col("_n") * test_size))
    return p.withColumn("is_test", (F.col("_n") > min_rows) & (F.col("_pos") > F.col("_n") - n_test)) \
        .drop("_pos", "_n")


def hash_unit(key: Column) -> Column:
    """Deterministic pseudo-uniform number in [0, 1) from an integer key (Knuth
    multiplicative hash mod 2^32) that any SQL engine can reproduce. Decimal arithmetic,
    so 64-bit keys cannot overflow."""
    prod = key.cast("decimal(20,0)") * F.lit(2654435761).cast("decimal(10,0)")
    return (prod % F.lit(4294967296).cast("decimal(10,0)")).cast("double") / 4294967296.0


def random_split(df: DataFrame, key: str, test_size: float = 0.2) -> DataFrame:
    return df.withColumn("is_test", hash_unit(F.col(key)) < test_size)


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2) -> DataFrame:
    """Within each label, the rows with the smallest hash values (round(test_size * n_label)
    of them) are test rows; positions from ``group_positions``."""
    h = df.withColumn("_h", hash_unit(F.col(key)))
    p = group_positions(h, [label], "_h", "_pos", "_n")
    return p.withColumn("is_test", F.col("_pos") <= F.round(F.col("_n") * test_size)).drop("_h", "_pos", "_n")


def coo_matmul(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sparse product C = A B with A as (i, k, a) and B as (k, j, b) entries: join on the
    inner index, ``sum(a * b)`` per (i, j)."""
    return a.join(b, "k").groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("value"))
