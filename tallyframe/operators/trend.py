"""Piecewise linear trend with Fourier seasonality, many series at once.

y = m + k u + sum_j d_j max(u - s_j, 0) + seasonality, u running from 0 to 1 over a series and y
divided by its largest size. The bends d_j at ``changepoints`` places, evenly spread over the
first ``reach`` of the rows, have a Laplace prior of scale ``flexibility``; offset, slope and
seasonality have wide normal priors. With the noise variance estimated as well, the most
probable parameters are a lasso on the bends alone: the other columns are solved out of the
matrix of cross products, then coordinate descent runs on stacks of those matrices.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import Lists, cross_products, doubles, packed, per_batch, schema_of, stacks

YEAR = 365.25
TREND_SD, SEASON_SD = 5.0, 10.0   # prior deviations of offset and slope, of Fourier weights
SWEEPS, ROUNDS = 500, 30          # coordinate sweeps a round; rounds of the noise variance
FLOOR = 1e-10                     # least noise variance, as a share of the mean square


def _knots(size: np.ndarray, count: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of every knot, whether it counts), (series, count): short series have fewer."""
    last = np.maximum(np.floor(size * reach).astype(int) - 1, 0)
    at = np.rint(np.arange(count + 1) * last[:, None] / max(count, 1)).astype(int)
    return at[:, 1:], np.diff(at, axis=1) > 0


def _on_support(s: np.ndarray, r: np.ndarray, penalty: np.ndarray, d: np.ndarray, free: np.ndarray):
    """(the least point among those with the signs of ``d``, whether it is the least of all)."""
    sign = np.sign(d)
    on = sign != 0
    a = s * (on[:, :, None] & on[:, None, :]) + np.eye(d.shape[1]) * ~on[:, :, None]
    a += 1e-13 * np.einsum("sii->si", s).max(1, initial=0.0)[:, None, None] * np.eye(d.shape[1])
    new = np.linalg.solve(a, np.where(on, r - penalty[:, None] * sign, 0.0)[..., None])[..., 0]
    pull = np.abs(r - (s * new[:, None]).sum(2))
    return new, np.where(on, np.sign(new) == sign, (pull <= penalty[:, None] * (1 + 1e-7)) | ~free).all(1)


def lasso(s: np.ndarray, r: np.ndarray, penalty: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows d that minimise d's d / 2 - r'd + penalty |d|_1 for a stack of matrices ``s``;
    coordinates with an empty diagonal stay 0. Coordinate sweeps find the signs; once those
    are right, the rest is one linear system."""
    out, live = start.copy(), np.arange(len(start))
    d = start.copy()
    for sweep in range(SWEEPS):
        diag = np.einsum("sii->si", s)
        free = diag > 1e-12
        if sweep % 4 == 0:
            new, least = _on_support(s, r, penalty, d, free)
            out[live] = np.where(least[:, None], new, d)
            if least.all():
                break
            if least.any():
                on = ~least
                live, s, r, penalty, d, diag, free = (v[on] for v in (live, s, r, penalty, d, diag, free))
        for j in range(d.shape[1]):
            pull = r[:, j] - (s[:, j] * d).sum(1) + diag[:, j] * d[:, j]
            new = np.sign(pull) * np.maximum(np.abs(pull) - penalty, 0) / np.where(free[:, j], diag[:, j], 1.0)
            d[:, j] = np.where(free[:, j], new, 0.0)
    else:
        out[live] = d
    return out


def bend(g: np.ndarray, plain: int, flexibility: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights of all columns, noise variance) from cross products ``g`` of [1, u, seasonality,
    hinges, y]; the first ``plain`` columns are not penalised by size."""
    n = np.maximum(g[:, 0, 0], 1.0)
    guu, guh, guy = g[:, :plain, :plain], g[:, :plain, plain:-1], g[:, :plain, -1]
    prior = np.full(plain, 1 / SEASON_SD ** 2)
    prior[:2] = 1 / TREND_SD ** 2
    d = np.zeros((len(g), guh.shape[2]))
    least = FLOOR * g[:, -1, -1] / n + 1e-300

    def others(noise, d):
        """The unpenalised columns' matrix and their weights beside the bends ``d``."""
        a = guu + (noise[:, None] * prior + 1e-12 * n[:, None])[:, :, None] * np.eye(plain)
        return a, np.linalg.solve(a, (guy - (guh * d[:, None]).sum(2))[..., None])[..., 0]

    def variance(u, d):
        w = np.concatenate([-u, -d, np.ones((len(g), 1))], 1)
        return np.maximum(np.einsum("si,sij,sj->s", w, g, w) / n, least)

    _, u = others(least, d)
    noise = variance(u, d)
    for _ in range(ROUNDS):
        a, _ = others(noise, d)
        out = np.linalg.solve(a, np.concatenate([guh, guy[..., None]], 2))
        left = guh.transpose(0, 2, 1) @ out
        d = lasso(g[:, plain:-1, plain:-1] - left[..., :-1], g[:, plain:-1, -1] - left[..., -1],
                  noise / flexibility, d)
        _, u = others(noise, d)
        before, noise = noise, variance(u, d)
        if (np.abs(noise - before) <= 1e-5 * before).all():
            break
    return np.concatenate([u, d], 1), noise


def season_columns(days: np.ndarray, seasonality: dict[str, tuple[float, int]]) -> list[np.ndarray]:
    return [f(days * (2 * np.pi * k / period)) for period, order in seasonality.values()
            for k in range(1, order + 1) for f in (np.sin, np.cos)]


def fit_stack(y: np.ndarray, days: np.ndarray, size: np.ndarray, seasonality: dict, changepoints: int = 25,
              reach: float = 0.8, flexibility: float = 0.05) -> dict[str, np.ndarray]:
    """Trends of a stack of series (time, series); ``days`` are day numbers in time order.
    Slopes, bends and knots come in years, values in the units of ``y``."""
    mask = np.arange(len(y))[:, None] < size
    first = np.where(size > 0, days[0], 0.0)
    span = np.take_along_axis(days, np.maximum(size - 1, 0)[None], 0)[0] - first
    span = np.where(span > 0, span, 1.0)
    scale = np.abs(np.where(mask, y, 0.0)).max(0)
    scale = np.where(scale > 0, scale, 1.0)
    u = (days - first) / span
    at, counts = _knots(size, changepoints, reach)
    knots = np.take_along_axis(u, at.T, 0).T
    hinges = [np.where(counts[:, j], np.maximum(u - knots[:, j], 0), 0.0) for j in range(changepoints)]
    cols = [np.ones_like(u), u, *season_columns(days, seasonality)]
    g = cross_products(np.stack([*cols, *hinges, y / scale], -1), mask)
    w, noise = bend(g, len(cols), flexibility)
    full = np.concatenate([-w, np.ones((len(size), 1))], 1)
    n = np.maximum(size, 1)
    spread = lambda v: np.einsum("si,sij,sj->s", v, g, v) / n - (np.einsum("si,si->s", g[:, 0], v) / n) ** 2
    whole = np.zeros_like(full)
    whole[:, -1] = 1.0
    with np.errstate(all="ignore"):
        explained = np.where(spread(whole) > 1e-15, 1 - spread(full) / spread(whole), np.nan)
    p = len(cols)
    return {"intercept": scale * (w[:, 0] - w[:, 1] * first / span), "slope": scale * w[:, 1] * YEAR / span,
            "season": scale[:, None] * w[:, 2:p], "bends": (scale * YEAR / span)[:, None] * w[:, p:],
            "knots": (first[:, None] + span[:, None] * knots) / YEAR, "sigma": scale * np.sqrt(noise),
            "explained_variance": explained}


def trend_fit(df: DataFrame, y: str, t: str, keys: Sequence[str], seasonality: dict[str, tuple[float, int]],
              changepoints: int = 25, reach: float = 0.8, flexibility: float = 0.05) -> DataFrame:
    """One row per series: n, sigma (noise), intercept, coef (slope a year, then the Fourier
    weights), knots (years since 1970) and bends (change of slope a year) where the trend bends,
    explained_variance (null for a constant series). Rows with a null date or value take no part;
    null keys are a series; series without rows and empty tables give none."""
    keys = list(keys)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("double")
    rows = packed(df.select(*keys, t, y, days.alias("_day")), keys, t, {"_days": "_day", "_y": y})
    rows = rows.select(*keys, "_days", "_y").where(F.size("_y") > 0)
    schema = schema_of(df, keys, "n long, sigma double, intercept double, coef array<double>, knots array<double>, "
                                 "bends array<double>, explained_variance double")
    wide = 4 + changepoints + 2 * sum(order for _, order in seasonality.values())

    def step(batch: pa.RecordBatch) -> pa.Table:
        values, day = Lists(batch.column("_y")), Lists(batch.column("_days"))
        one = {c: np.full(batch.num_rows, np.nan) for c in ("sigma", "intercept", "explained_variance")}
        many = {c: [np.zeros(0)] * batch.num_rows for c in ("coef", "knots", "bends")}
        for at in stacks(values.size * wide):
            m = fit_stack(values.stack(at), day.stack(at), values.size[at], seasonality, changepoints, reach, flexibility)
            for c in one:
                one[c][at] = m[c]
            for i, row in enumerate(at):
                bent = m["bends"][i] != 0
                many["coef"][row] = np.concatenate([m["slope"][i:i + 1], m["season"][i]])
                many["knots"][row], many["bends"][row] = m["knots"][i][bent], m["bends"][i][bent]
        out = pa.Table.from_batches([batch]).select(keys)
        n = pa.array(values.size)
        out = out.append_column("n", n) if keys else pa.table({"n": n})
        for c, v in one.items():
            out = out.append_column(c, pa.array(v, pa.float64(), from_pandas=True))
        for c, v in many.items():
            out = out.append_column(c, doubles(v))
        return out

    return per_batch(rows, schema, step)


def trend_value(names: Sequence[str]) -> Column:
    """The fitted value of a row joined to its ``trend_fit`` row; ``names`` are its feature
    columns, the first of them the time in years since 1970."""
    v = F.col("intercept")
    for i, n in enumerate(names):
        v = v + F.col("coef")[i] * F.col(n)
    hinges = F.zip_with("knots", "bends", lambda k, b: b * F.greatest(F.col(names[0]) - k, F.lit(0.0)))
    return v + F.aggregate(hinges, F.lit(0.0), lambda a, b: a + b)
