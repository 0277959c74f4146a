"""Many-series forecasting: stationarity test, ARIMA order search and forecast, Fourier
trend model, hybrid ridge + ARIMA, fallback, backtest, report.

Input series are period series ``(keys, t, y)`` — one row per entity and period (the
output of a calendar group-by), so per-series windows are calendar-bounded.

Tests and ARIMA models (``arima``) run on stacks of whole period series in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.mathx import norm_cdf_sql
from .arima import arima_forecast, arima_select
from .linear import ridge_cv
from .ranks import series_positions
from .series import Lists, cross_products, packed, per_batch, schema_of, solve_all, stacks
from .trend import trend_fit, trend_value


# ---- Y1: summary + Dickey-Fuller ---------------------------------------------------

# MacKinnon (2010) response-surface coefficients for the constant-only
# Dickey-Fuller critical values: level -> (b_inf, b1, b2, b3).
DF_CRIT = {"1%": (-3.43035, -6.5393, -16.786, -79.433),
           "5%": (-2.86154, -2.8903, -4.234, -40.040),
           "10%": (-2.56677, -1.5384, -2.809, 0.0)}


def df_critical(n: int, level: str = "5%") -> float:
    b = DF_CRIT[level]
    return b[0] + b[1] / n + b[2] / n ** 2 + b[3] / n ** 3


# MacKinnon (1994) response surface of the p-value, constant only, as
# polynomials of the statistic under the normal distribution function (from -1.61 down / up),
# and the range beyond which p is 0 or 1.
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
P_TURN, P_RANGE = -1.61, (-18.83, 2.74)


def df_p_value_sql(x: str) -> str:
    """p-value of a Dickey-Fuller statistic ``x`` (constant, no trend) as SQL text."""
    def surface(coefs):
        s = repr(coefs[-1])
        for c in reversed(coefs[:-1]):
            s = f"({s} * {x} + {c!r})"
        return norm_cdf_sql(s)
    return (f"(CASE WHEN {x} > {P_RANGE[1]} THEN 1.0 WHEN {x} < {P_RANGE[0]} THEN 0.0 "
            f"WHEN {x} <= {P_TURN} THEN {surface(P_SMALL)} ELSE {surface(P_LARGE)} END)")


def lag_limit(n: np.ndarray) -> np.ndarray:
    """Most lagged differences tried on n values: ceil(12 (n / 100)^(1/4)), at most n // 2 - 2."""
    return np.maximum(np.minimum(np.ceil(12 * (n / 100) ** 0.25), n // 2 - 2), 0).astype(int)


def _lagged(y: np.ndarray, lags: int) -> np.ndarray:
    """(time, series, lags + 2): level before, differences before (nearest first), difference."""
    dy = np.diff(y, axis=0)
    cols = [y[:-1]] + [np.concatenate([np.zeros_like(dy[:i]), dy[:max(0, len(dy) - i)]])[:len(dy)]
                       for i in range(1, lags + 1)] + [dy]
    return np.stack(cols, -1)


def _centred(x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Cross products of ``x`` about its means over the rows of ``mask``."""
    mean = np.where(mask[..., None], x, 0.0).sum(0) / np.maximum(mask.sum(0), 1)[:, None]
    return cross_products(x - mean, mask)


def _nested(g: np.ndarray, n: np.ndarray, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """(t statistic of the level, AIC) of the regression on the first ``lags`` differences, for
    every matrix of centred cross products ``g`` over ``n`` rows."""
    k = lags + 1
    s, sy, yy = g[:, :k, :k], g[:, :k, -1], g[:, -1, -1]
    size = np.sqrt(np.einsum("sii->si", s))
    size = np.where(size > 0, size, 1.0)
    s, sy = s / size[:, :, None] / size[:, None, :], sy / size
    with np.errstate(all="ignore"):
        coef = solve_all(s, sy)
        rss = yy - (coef * sy).sum(1)
        unit = np.zeros(sy.shape)
        unit[:, 0] = 1.0
        stat = coef[:, 0] / np.sqrt(rss / (n - k - 1) * solve_all(s, unit)[:, 0])
        return np.where((n > k + 1) & (rss > 0), stat, np.nan), n * np.log(rss / n) + 2 * (k + 1)


def dickey_fuller(y: np.ndarray, size: np.ndarray, lags: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(t statistic, lagged differences used) of every series of a stack (time, series). Without
    ``lags`` each series takes the number with the lowest AIC up to its ``lag_limit``, all
    tried on the same rows as nested blocks of one matrix, and is fitted again on all its rows."""
    used = np.full(len(size), lags or 0)
    most = int(lag_limit(size).max(initial=0)) if lags is None else lags
    if len(y) < 2:
        return np.full(len(size), np.nan), used
    x = _lagged(y, most)
    t = np.arange(len(x))[:, None]
    if lags is None:
        limit = lag_limit(size)
        mask = (t >= limit) & (t < size - 1)
        g, best = _centred(x, mask), np.full(len(size), np.inf)
        for k in range(most + 1):
            at = np.flatnonzero(limit >= k)
            stat, aic = _nested(g[at][:, [*range(k + 1), -1]][:, :, [*range(k + 1), -1]], mask.sum(0)[at], k)
            lower = np.isfinite(stat) & (aic < best[at])
            best[at] = np.where(lower, aic, best[at])
            used[at] = np.where(lower, k, used[at])
    out = np.full(len(size), np.nan)
    for k in np.unique(used):
        at = np.flatnonzero(used == k)
        mask = (t >= k) & (t < size[at] - 1)
        out[at] = _nested(_centred(x[:, at][..., [*range(k + 1), -1]], mask), mask.sum(0), int(k))[0]
    return out, used


def stationarity(df: DataFrame, y: str, t: str, keys: Sequence[str] = (), lags: int | None = 1,
                 min_n: int = 10) -> DataFrame:
    """Per series: n, first / last period, mean, std, and the augmented Dickey-Fuller
    t statistic of dy_t = a + g y_{t-1} + sum b_i dy_{t-i}, compared with the 5 % MacKinnon
    critical value, and its p-value. ``lags`` lagged differences, or (None) the number with the
    lowest AIC, as in ``dickey_fuller``. The test needs n > ``min_n`` values.

    Periods with a null value take no part in the test (the series closes up); null keys are a
    series; constant series have a null statistic; an empty table gives no rows. Output also:
    df_n (rows of the regression), df_lags, crit_5, stationary."""
    keys = list(keys)
    col = F.col(y)
    rows = packed(df, keys, t, {"_y": y}, [
        F.count(col).alias("n"), F.min(t).alias("first"), F.max(t).alias("last"), F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std")])
    head = [*keys, "n", "first", "last", "mean", "std"]
    rows = rows.select(*head, "_y")
    schema = schema_of(rows, head, "df_n long, df_lags int, adf_stat double, crit_5 double")

    def step(batch: pa.RecordBatch) -> pa.Table:
        values = Lists(batch.column("_y"))
        stat, used = np.full(batch.num_rows, np.nan), np.zeros(batch.num_rows, np.int64)
        for at in stacks(values.size):
            stat[at], used[at] = dickey_fuller(values.stack(at), values.size[at], lags)
        n = np.maximum(values.size - 1 - used, 0)
        crit = np.array([df_critical(int(v)) if v else math.nan for v in n])
        out = pa.Table.from_batches([batch]).select(head)
        out = out.append_column("df_n", pa.array(n)).append_column("df_lags", pa.array(used.astype(np.int32)))
        for name, v in (("adf_stat", stat), ("crit_5", crit)):
            out = out.append_column(name, pa.array(v, pa.float64(), from_pandas=True))
        return out

    out = per_batch(rows, schema, step)
    ok = F.col("n") > min_n
    return out.withColumn("stationary", F.when(ok, F.col("adf_stat") < F.col("crit_5"))) \
        .withColumn("adf_stat", F.when(ok, F.col("adf_stat"))) \
        .withColumn("p_value", F.expr(f"CASE WHEN adf_stat IS NOT NULL THEN {df_p_value_sql('adf_stat')} END"))


# ---- Y7: fallback -------------------------------------------------------------------

def fallback_forecast(df: DataFrame, y: str, t: str, keys: Sequence[str] = (), horizon: int = 6,
                      growth: float = 0.01) -> DataFrame:
    """last value * (1 + growth * i), i = 0..h-1, dated at the following month ends."""
    keys = list(keys)
    last = df.groupBy(*keys).agg(F.max_by(y, t).alias("_last"), F.max(t).alias("_t")) if keys else \
        df.agg(F.max_by(y, t).alias("_last"), F.max(t).alias("_t"))
    x = last.select(*keys, "_last", "_t", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("i"))
    return x.select(*keys, (F.col("i") + 1).alias("step"),
                    F.last_day(F.add_months(F.col("_t"), F.col("i") + 1)).alias("month_end"),
                    (F.col("_last") * (1 + growth * F.col("i"))).alias("forecast"),
                    F.col("_last").alias("linear_part"), F.lit(0.0).alias("arima_part"))


# ---- Y6: scenario uplift and interval widening --------------------------------------

def scenario(fc: DataFrame, step_col: str = "step", uplift: float = 0.005, widen: float = 0.1) -> DataFrame:
    """forecast * (1 + uplift * i); bounds moved by uplift * i * (1 + widen * i), i = step - 1.
    (The reference also adds seeded N(0, 0.02) noise; that numpy stream is not
    reproducible in Spark and is left out.)"""
    i = F.col(step_col) - 1
    v = uplift * i
    f = 1 + widen * i
    return (fc.withColumn("forecast", F.col("forecast") * (1 + v))
              .withColumn("lower", F.col("lower") * (1 - v * f))
              .withColumn("upper", F.col("upper") * (1 + v * f)))


# ---- Y8: Fourier trend + seasonality ------------------------------------------------

def fourier_features(df: DataFrame, t: str, periods: dict[str, tuple[float, int]], origin: str = "1970-01-01"):
    """Trend (days since origin / 365.25) and sin / cos(2 pi k days / P) columns."""
    days = F.datediff(F.to_date(t), F.lit(origin).cast("date")).cast("double")
    cols = [(days / 365.25).alias("_trend")]
    names = ["_trend"]
    for name, (period, order) in periods.items():
        for k in range(1, order + 1):
            ang = days * (2 * math.pi * k / period)
            cols += [F.sin(ang).alias(f"_{name}_s{k}"), F.cos(ang).alias(f"_{name}_c{k}")]
            names += [f"_{name}_s{k}", f"_{name}_c{k}"]
    return df.select("*", *cols), names


# Seasonal periods (days) and Fourier orders.
SEASONALITY = {"yearly": (365.25, 3), "monthly": (30.5, 3)}


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys) if keys else left.crossJoin(F.broadcast(right))


def fourier_model(df: DataFrame, y: str, t: str, keys: Sequence[str] = (), split: float = 0.8,
                  seasonality: dict | None = None, **trend) -> DataFrame:
    """Trend with changepoints + Fourier seasonality per series (``trend.trend_fit``, to which
    ``trend`` goes), fitted on the first ``split`` of each series; returns per series the
    fitted parameters and the validation MAE on the rest."""
    from ..session import cut_lineage
    keys = list(keys)
    seas = seasonality or SEASONALITY
    x, names = fourier_features(df, t, seas)
    pos = cut_lineage(series_positions(x, keys, t, "_pos", "_n"))  # period series, read by fit and validation
    fit = trend_fit(pos.where(F.col("_pos") <= F.floor(F.col("_n") * split)), y, t, keys, seas, **trend)
    valid = pos.where(F.col("_pos") > F.floor(F.col("_n") * split))
    err = _joined(valid, fit, keys).groupBy(*keys).agg(
        F.avg(F.abs(F.col(y) - trend_value(names))).alias("mae_validation"), F.count(F.lit(1)).alias("n_validation"))
    return fit.join(err, keys, "left") if keys else fit.crossJoin(err)


# ---- Y9: backtest -------------------------------------------------------------------

def fourier_predict(train: DataFrame, test: DataFrame, y: str, t: str, keys: Sequence[str] = (),
                    seasonality: dict | None = None) -> DataFrame:
    """Fit trend + Fourier terms on ``train`` per series and predict ``test`` rows
    (column ``forecast``)."""
    keys = list(keys)
    seas = seasonality or {"yearly": SEASONALITY["yearly"]}
    fit = trend_fit(train, y, t, keys, seas)
    x, names = fourier_features(test, t, seas)
    j = _joined(x, fit, keys).withColumn("forecast", trend_value(names))
    return j.drop(*names, "n", "sigma", "intercept", "coef", "knots", "bends", "explained_variance")


def fourier_forecast(df: DataFrame, y: str, t: str, keys: Sequence[str] = (), horizon: int = 30,
                     freq: str = "D", z: float = 1.2815515655446004, min_rows: int = 12,
                     seasonality: dict | None = None) -> DataFrame:
    """``horizon`` future days (``freq`` D) or weeks (W) after each series' end from its trend
    and Fourier terms, with the 80 % band of the fit's residuals and money text. Series with
    fewer than ``min_rows`` values give no rows, and neither does any other frequency."""
    from ..functions.expr import money
    from ..session import cut_lineage
    keys = list(keys)
    seas = seasonality or SEASONALITY
    x, names = fourier_features(df.select(*keys, t, y).na.drop(subset=[t, y]), t, seas)
    x = cut_lineage(x)  # period series, read by the fit, its residuals and the series' ends
    fit = cut_lineage(trend_fit(x, y, t, keys, seas).select(*keys, "intercept", "coef", "knots", "bends"))
    yhat = trend_value(names)
    ends = _joined(x, fit, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.to_date(t)).alias("_end"),
        F.sqrt(F.avg((F.col(y) - yhat) ** 2)).alias("_sd"))
    days = {"D": 1, "W": 7}.get(freq, 0)
    future = (ends.where((F.col("_rows") >= min_rows) & F.lit(days > 0))
              .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
              .withColumn(t, F.date_add("_end", F.col("step") * days)))
    f, _ = fourier_features(future, t, seas)
    f = _joined(f, fit, keys).withColumn("forecast", yhat)
    half = F.col("_sd") * z
    f = f.select(*keys, "step", t, "forecast", (F.col("forecast") - half).alias("lower"),
                 (F.col("forecast") + half).alias("upper"))
    return f.withColumn("forecast_text", money("forecast"))


def backtest(df: DataFrame, y: str, t: str, keys: Sequence[str] = (), hold: int = 6,
             order=None, models: Sequence[str] = ("arima", "fourier"), **select_kw) -> DataFrame:
    """Hold out each series' last ``hold`` rows, fit each model on the rest and score
    MAE / RMSE on the held-out rows: ARIMA (order selected on the train part, or a fixed
    ``order``) and trend + yearly Fourier seasonality. Series with n <= hold are skipped.
    Output: keys, model, mae, rmse, held_out."""
    keys = list(keys)
    pos = series_positions(df.select(*keys, t, y), keys, t, "_pos", "_n").where(F.col("_n") > hold)
    train = pos.where(F.col("_pos") <= F.col("_n") - hold).drop("_pos", "_n")
    test = pos.where(F.col("_pos") > F.col("_n") - hold).withColumn("step", (F.col("_pos") - F.col("_n") + hold).cast("int"))
    scored = []
    if "arima" in models:
        if order is None:
            model = arima_select(train, y, t, keys, **select_kw)
        else:
            model = arima_select(train, y, t, keys, max_p=order[0], max_d=order[1], max_q=order[2], **select_kw) \
                .where((F.col("p") == order[0]) & (F.col("d") == order[1]) & (F.col("q") == order[2]))
        fc = arima_forecast(train, y, t, model, keys, horizon=hold)
        scored.append(test.join(fc, keys + ["step"]).select(*keys, F.lit("arima").alias("model"), y, "forecast"))
    if "fourier" in models:
        fp = fourier_predict(train, test.drop("_pos", "_n", "step"), y, t, keys)
        scored.append(fp.select(*keys, F.lit("fourier").alias("model"), y, "forecast"))
    allm = scored[0]
    for sc in scored[1:]:
        allm = allm.unionByName(sc)
    e = F.col(y) - F.col("forecast")
    return allm.groupBy(*keys, "model").agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                                            F.count(F.lit(1)).alias("held_out"))


# ---- Y10: report -------------------------------------------------------------------

def forecast_report(df: DataFrame, y: str, t: str, fc: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """History mean / last / first-to-last trend %, forecast mean, % change vs last,
    expected range (min lower, max upper), with money-formatted text."""
    from ..functions.expr import money
    keys = list(keys)
    h = df.groupBy(*keys).agg(F.count(y).alias("months"), F.avg(y).alias("history_mean"),
                              F.min_by(y, t).alias("_first"), F.max_by(y, t).alias("last_value"))
    h = h.withColumn("trend_pct", F.try_divide(F.col("last_value") - F.col("_first"), F.col("_first")) * 100).drop("_first")
    f = fc.groupBy(*keys).agg(F.avg("forecast").alias("forecast_mean"), F.min("lower").alias("range_low"),
                              F.max("upper").alias("range_high"))
    r = h.join(f, keys)
    r = r.withColumn("change_vs_last_pct", F.try_divide(F.col("forecast_mean") - F.col("last_value"), F.col("last_value")) * 100)
    return r.withColumn("range_text", F.concat(money("range_low"), F.lit(" - "), money("range_high"))) \
        .withColumn("direction", F.when(F.col("trend_pct") > 0, "alza").otherwise("baja"))


def forecast_reports(df: DataFrame, y: str, t: str, forecasts: dict[str, DataFrame],
                     keys: Sequence[str] = ()) -> DataFrame:
    """``forecast_report`` per series and model: one row for each forecast of each series."""
    parts = [forecast_report(df, y, t, fc, keys).withColumn("model", F.lit(name))
             for name, fc in forecasts.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ---- Y5: hybrid ---------------------------------------------------------------------

def hybrid(df: DataFrame, y: str, t: str, xcols: Sequence[str], keys: Sequence[str] = (), horizon: int = 3,
           alphas: Sequence[float] = tuple(np.logspace(-3, 3, 20)), folds: int = 3,
           standardize: Sequence[str] | None = None, fallback_band: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Ridge (alpha by expanding-window CV, R^2 scoring; only ``standardize`` columns are
    scaled, indicators stay 0/1) on the exogenous features, then
    ARIMA (p <= 2, d <= 1, q <= 2) on its residuals; the forecast holds each series' last
    feature row constant (exogenous hold) and adds the residual forecast.

    Returns (forecast rows: keys, step, linear_part, arima_part, forecast, lower, upper;
    training metrics per series: alpha, order, aic, explained variance)."""
    from ..session import cut_lineage
    keys, xcols = list(keys), list(xcols)
    df = cut_lineage(df.select(*keys, t, y, *xcols))  # period series, reused by every step below
    lin = ridge_cv(df, y, xcols, t, keys, alphas=alphas, scheme="timeseries", folds=folds, scoring="r2",
                   standardize=standardize)
    j = df.join(lin, keys) if keys else df.crossJoin(F.broadcast(lin))
    yhat = F.col("intercept")
    for i, c in enumerate(xcols):
        yhat = yhat + F.col("coef")[i] * F.col(c)
    res = cut_lineage(j.select(*keys, t, (F.col(y) - yhat).alias("_res"), *xcols))
    model = arima_select(res, "_res", t, keys, max_p=2, max_d=1, max_q=2)
    rf = arima_forecast(res, "_res", t, model, keys, horizon=horizon)
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*xcols), t).alias("_x")) if keys else \
        df.agg(F.max_by(F.struct(*xcols), t).alias("_x"))
    lp = last.join(lin, keys) if keys else last.crossJoin(lin)
    lin_part = F.col("intercept")
    for i, c in enumerate(xcols):
        lin_part = lin_part + F.col("coef")[i] * F.col(f"_x.{c}")
    lp = lp.select(*keys, lin_part.alias("linear_part"))
    out = rf.join(lp, keys) if keys else rf.crossJoin(lp)
    # residual-model interval around the linear part; +-5 % of it when the residual
    # model gives no variance
    lo = F.coalesce(F.col("linear_part") + F.col("lower"), F.col("linear_part") * (1 - fallback_band))
    hi = F.coalesce(F.col("linear_part") + F.col("upper"), F.col("linear_part") * (1 + fallback_band))
    out = out.select(*keys, "step", "linear_part", F.col("forecast").alias("arima_part"),
                     (F.col("linear_part") + F.coalesce(F.col("forecast"), F.lit(0.0))).alias("forecast"),
                     lo.alias("lower"), hi.alias("upper"))
    metrics = lin.select(*keys, F.col("best_alpha").alias("alpha_ridge"), "explained_variance") \
        .join(model.select(*keys, "p", "d", "q", F.col("aic").alias("aic_arima")), keys) if keys else \
        lin.select(F.col("best_alpha").alias("alpha_ridge"), "explained_variance").crossJoin(
            model.select("p", "d", "q", F.col("aic").alias("aic_arima")))
    # residual diagnostics: mean, std, trend warning (|mean| > std), ADF on the residuals
    diag = stationarity(res, "_res", t, keys, lags=1).select(
        *keys, F.col("mean").alias("residual_mean"), F.col("std").alias("residual_std"),
        F.col("adf_stat").alias("residual_adf_stat"), F.col("stationary").alias("residual_stationary"))
    diag = diag.withColumn("residual_trend", F.abs("residual_mean") > F.col("residual_std"))
    metrics = metrics.join(diag, keys) if keys else metrics.crossJoin(diag)
    return out, metrics
