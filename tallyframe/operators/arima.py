"""ARIMA of many series: order search by AIC and forecasts, on stacks of whole period series.

Spark brings every series together as one row of arrays (``series.packed``); a task fits a
stack of series at once, every order of the grid in turn:

  1. start: Hannan-Rissanen, a long autoregression for the innovations, then least squares on
     lags of values and innovations, from one matrix of cross products per series;
  2. refinement: the conditional sum of squares is lowered by damped Gauss-Newton steps
     (Levenberg-Marquardt, damped per series). The slopes of the innovations by the parameters
     follow the moving-average recursion itself. Steps that leave the stationary and
     invertible region, or do not lower the sum, are not taken.

All orders of a series are scored on the same rows, AIC = n ln(RSS / n) + 2 k.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import (Lists, cross_products, doubles, largest_root, packed, per_batch, recur, same_keys,
                     schema_of, solve_all, stacks)

Z95 = 1.959963984540054
LIMIT = 0.999     # largest root of a fitted AR or MA part
ROUNDS = 20       # Gauss-Newton steps at most; most series need 3 to 6
CLOSE = 1e-9      # relative gain of a step that ends the descent


def order_grid(max_p: int, max_d: int, max_q: int) -> list[tuple[int, int, int]]:
    return [(p, d, q) for p in range(max_p + 1) for d in range(max_d + 1) for q in range(max_q + 1)
            if (p, d, q) != (0, 0, 0)]


class Stack:
    """d-th differences of a stack of series, (time, series), and the rows its orders are scored on.

    Values are scaled to unit size per series; for d = 0 their mean is taken off, too, and the
    model has a constant. ``ex`` are the regressors' differences, (time, series, columns)."""

    def __init__(self, y: np.ndarray, ex: np.ndarray, size: np.ndarray, d: int, max_d: int, lags: int):
        z, x = np.diff(y, n=d, axis=0), np.diff(ex, n=d, axis=0)
        self.first = max_d - d + lags            # first scored row
        self.n = np.maximum(size - max_d - lags, 0)
        t = np.arange(len(z))[:, None]
        known = t < size - d
        self.mask = (t >= self.first) & known
        count = np.maximum(known.sum(0), 1)
        self.const = d == 0
        self.mean = np.where(known, z, 0).sum(0) / count if self.const else np.zeros(len(size))
        z = np.where(known, z - self.mean, 0)
        self.scale = np.sqrt((z ** 2).sum(0) / count)
        # rounding left over from a constant series is no variation
        flat = self.scale <= 1e-12 * np.abs(np.where(t < size, y[:len(z)], 0)).max(0, initial=0)
        self.flat = flat | (self.scale == 0)
        self.scale[self.flat] = 1.0
        self.z = z / self.scale
        self.x_mean = np.where(known[..., None], x, 0).sum(0) / count[:, None] if self.const else 0.0
        x = np.where(known[..., None], x - self.x_mean, 0)
        self.x_scale = np.sqrt((x ** 2).sum(0) / count[:, None])
        self.x_scale[self.x_scale == 0] = 1.0
        self.x = x / self.x_scale
        self.known = known

    def errors(self, par: np.ndarray, p: int, q: int) -> np.ndarray:
        """Innovations, zero before the first scored row."""
        u, c, phi, theta, _ = self._parts(par, p, q)
        e = u - c
        for i in range(1, p + 1):
            e[i:] -= phi[:, i - 1] * u[:-i]
        return recur(np.where(self.mask, e, 0.0), theta)

    def slopes(self, par: np.ndarray, e: np.ndarray, p: int, q: int) -> np.ndarray:
        """Derivatives of the innovations by the parameters, (time, series, parameters)."""
        u, _, phi, theta, _ = self._parts(par, p, q)
        cols = [np.full(u.shape, -1.0)] if self.const else []
        shifted = lambda v, i: np.concatenate([np.zeros_like(v[:i]), v[:-i]])
        cols += [-shifted(u, i) for i in range(1, p + 1)] + [-shifted(e, k) for k in range(1, q + 1)]
        for j in range(self.x.shape[2]):
            g = -self.x[..., j]
            for i in range(1, p + 1):
                g = g + phi[:, i - 1] * shifted(self.x[..., j], i)
            cols.append(g)
        if not cols:
            return np.zeros((*u.shape, 0))
        return recur(np.where(self.mask[..., None], np.stack(cols, -1), 0.0), theta)

    def _parts(self, par, p, q):
        o = 1 if self.const else 0
        c = par[:, 0] if self.const else np.zeros(len(par))
        beta = par[:, o + p + q:]
        u = self.z - (self.x * beta).sum(-1) if beta.shape[1] else self.z.copy()
        return u, c, par[:, o:o + p], par[:, o + p:o + p + q], beta

    def regression(self) -> np.ndarray:
        """Least-squares weights of the regressors, (series, columns)."""
        k = self.x.shape[2]
        one = np.ones((*self.z.shape, 1))
        g = cross_products(np.concatenate([one, self.x, self.z[..., None]], -1), self.known)
        beta = solve_all(g[:, :-1, :-1] + 1e-10 * np.eye(k + 1) * g[:, :1, :1], g[:, :-1, -1])
        return np.nan_to_num(beta[:, 1:])

    def starts(self, max_p: int, max_q: int, long_ar: int, orders: Sequence[tuple[int, int]]):
        """Hannan-Rissanen parameters of every (p, q) in ``orders``."""
        beta = self.regression()
        u = self.z - (self.x * beta).sum(-1)
        top = len(u)
        lag = lambda v, i: np.concatenate([np.zeros_like(v[:i]), v[:max(0, top - i)]])[:top]
        t = np.arange(top)[:, None]
        one = np.ones_like(u)
        long = np.stack([one, *[lag(u, i) for i in range(1, long_ar + 1)], u], -1)
        rows = self.known & (t >= long_ar)
        g = cross_products(long, rows)
        a = solve_all(g[:, :-1, :-1] + 1e-8 * np.eye(long_ar + 1) * (1 + g[:, :1, :1]), g[:, :-1, -1])
        e = np.where(rows, u - (long[..., :-1] * a).sum(-1), 0.0)
        both = np.stack([one, *[lag(u, i) for i in range(1, max_p + 1)],
                         *[lag(e, k) for k in range(1, max_q + 1)], u], -1)
        later = self.mask & (t >= long_ar + max_q)
        g = cross_products(both, later)
        enough = later.sum(0)
        for p, q in orders:
            at = ([0] if self.const else []) + list(range(1, p + 1)) + list(range(1 + max_p, 1 + max_p + q))
            s = g[:, at][:, :, at]
            par = solve_all(s + 1e-10 * np.eye(len(at)) * (1 + g[:, :1, :1]), g[:, at, -1])
            par = np.where((enough > len(at))[:, None] & np.isfinite(par), par, 0.0)
            o = 1 if self.const else 0
            for first, last, sign in ((o, o + p, 1), (o + p, o + p + q, -1)):
                part = par[:, first:last]
                root = largest_root(sign * part)
                pull = np.where(root >= LIMIT, 0.95 / np.maximum(root, LIMIT), 1.0)[:, None]
                par[:, first:last] = part * pull ** np.arange(1, last - first + 1)
            yield p, q, np.concatenate([par, beta], 1)

    def descend(self, par: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
        """(parameters, sum of squares) after damped Gauss-Newton steps from ``par``."""
        o = 1 if self.const else 0
        total = lambda e: np.where(self.mask, e * e, 0.0).sum(0)
        e = self.errors(par, p, q)
        rss = total(e)
        damp = np.full(len(rss), 1e-4)
        live = np.isfinite(rss) & (par.shape[1] > 0)
        slopes = None
        for _ in range(ROUNDS):
            if not live.any():
                break
            if slopes is None:
                slopes = self.slopes(par, e, p, q)
                g = cross_products(np.concatenate([slopes, e[..., None]], -1), self.mask)
                g = np.nan_to_num(g, posinf=0.0, neginf=0.0)
            h = g[:, :-1, :-1]
            diag = np.einsum("sii->si", h)
            ridge = damp[:, None] * diag + 1e-12 * (1 + diag.max(1, initial=0.0, keepdims=True))
            trial = par - solve_all(h + ridge[:, :, None] * np.eye(h.shape[-1]), g[:, :-1, -1])
            inside = live & np.isfinite(trial).all(1)
            trial = np.where(inside[:, None], trial, par)
            inside &= (largest_root(trial[:, o:o + p]) < LIMIT) & (largest_root(-trial[:, o + p:o + p + q]) < LIMIT)
            trial = np.where(inside[:, None], trial, par)
            after = self.errors(trial, p, q)
            lower = total(after)
            better = inside & (lower < rss)
            gain = np.where(better, rss - lower, 0.0)
            par = np.where(better[:, None], trial, par)
            e = np.where(better, after, e)
            live &= ~(better & (gain <= CLOSE * rss)) & (better | (damp < 1e4))
            rss = np.where(better, lower, rss)
            damp = np.where(better, np.maximum(damp / 10, 1e-8), damp * 10)
            if better.any():
                slopes = None
        return par, rss

    def units(self, par: np.ndarray, p: int, q: int):
        """(constant, phi, theta, beta) in the units of the data."""
        _, c, phi, theta, beta = self._parts(par, p, q)
        beta = beta * self.scale[:, None] / self.x_scale
        centre = self.mean - (beta * self.x_mean).sum(1) if self.const else np.zeros(len(par))
        return c * self.scale + centre * (1 - phi.sum(1)), phi, theta, beta


def best_orders(y: np.ndarray, ex: np.ndarray, size: np.ndarray, max_p: int, max_d: int, max_q: int,
                long_ar: int, default: tuple[int, int, int]) -> list[dict]:
    """The lowest-AIC model of every series of a stack (time, series). A series without more
    scored rows than parameters, or without variation, gets the ``default`` order with zeros."""
    k_ex = ex.shape[2]
    best = [dict(p=default[0], d=default[1], q=default[2], aic=math.nan, const=0.0, phi=np.zeros(default[0]),
                 theta=np.zeros(default[2]), beta=np.zeros(k_ex), sigma2=math.nan, n_eff=0) for _ in size]
    lowest, lags = np.full(len(size), np.inf), max(max_p, max_q)
    for d in range(max_d + 1):
        if len(y) <= d:
            continue
        s = Stack(y, ex, size, d, max_d, lags)
        orders = [(p, q) for p, dd, q in order_grid(max_p, max_d, max_q) if dd == d]
        for p, q, par in s.starts(max_p, max_q, long_ar, orders):
            par, rss = s.descend(par, p, q)
            k = p + q + 1 + s.const + k_ex
            with np.errstate(all="ignore"):
                sigma2 = rss / s.n * s.scale ** 2
                aic = s.n * np.log(sigma2) + 2 * k
            const, phi, theta, beta = s.units(par, p, q)
            ok = np.isfinite(aic) & (s.n > par.shape[1]) & ~s.flat
            for i in np.flatnonzero(ok & (aic < lowest)):
                lowest[i] = aic[i]
                best[i] = dict(p=p, d=d, q=q, aic=aic[i], const=const[i], phi=phi[i], theta=theta[i],
                               beta=beta[i], sigma2=sigma2[i], n_eff=s.n[i])
    return best


def _cube(lists: list[Lists], rows: np.ndarray, like: np.ndarray, end: bool = False) -> np.ndarray:
    return np.stack([v.stack(rows, end) for v in lists], -1) if lists else np.zeros((*like.shape, 0))


def _exog(exog: Sequence[str]) -> dict[str, str]:
    return {f"_x{j}": c for j, c in enumerate(exog)}


def arima_select(df: DataFrame, y: str, t: str, keys: Sequence[str] = (), max_p: int = 2, max_d: int = 1,
                 max_q: int = 2, long_ar: int = 6, default=(1, 0, 1), exog: Sequence[str] = ()) -> DataFrame:
    """Best (p, d, q) by AIC per series, and its parameters by conditional least squares. ``exog``
    columns enter as regressors (differenced like the series): a regression with ARIMA errors,
    all parameters fitted together.

    Periods with a null value or regressor take no part (the series closes up); null keys are
    a series; an empty table gives no rows; too short or constant series get ``default``, zero
    parameters and null aic and sigma2. Output: keys, p, d, q, aic, const, phi (array), theta
    (array), beta (array, exog coefficients), sigma2, n_eff.
    """
    keys, exog = list(keys), list(exog)
    names = ["_y", *_exog(exog)]
    rows = packed(df, keys, t, {"_y": y, **_exog(exog)}).select(*keys, *names)
    schema = schema_of(df, keys, "p int, d int, q int, aic double, const double, phi array<double>, "
                                 "theta array<double>, beta array<double>, sigma2 double, n_eff long")

    def step(batch: pa.RecordBatch) -> pa.Table:
        values, regressors = Lists(batch.column("_y")), [Lists(batch.column(c)) for c in names[1:]]
        found: list[dict] = [{}] * batch.num_rows
        for at in stacks(values.size):
            v = values.stack(at)
            for i, model in zip(at, best_orders(v, _cube(regressors, at, v), values.size[at], max_p, max_d,
                                                max_q, long_ar, default)):
                found[i] = model
        out = pa.Table.from_batches([batch]).select(keys)
        for name in ("p", "d", "q"):
            out = out.append_column(name, pa.array([m[name] for m in found], pa.int32()))
        for name in ("aic", "const", "sigma2"):
            out = out.append_column(name, pa.array([m[name] for m in found], pa.float64(), from_pandas=True))
        for name in ("phi", "theta", "beta"):
            out = out.append_column(name, doubles([m[name] for m in found]))
        return out.append_column("n_eff", pa.array([int(m["n_eff"]) for m in found], pa.int64()))

    return per_batch(rows, schema, step)


# ---- Y3/Y4: forecast ---------------------------------------------------------------

def psi_weights(phi: np.ndarray, theta: np.ndarray, d: int, h: int) -> np.ndarray:
    """(series, h) psi weights of phi(B) (1 - B)^d x = theta(B) e; ``phi`` is (series, p)."""
    s = len(phi)
    ar = np.concatenate([np.ones((s, 1)), -phi], 1)
    zero = np.zeros((s, 1))
    for _ in range(d):
        ar = np.concatenate([ar, zero], 1) - np.concatenate([zero, ar], 1)
    psi = np.zeros((s, h))
    for j in range(h):
        psi[:, j] = 1.0 if j == 0 else theta[:, j - 1] if j <= theta.shape[1] else 0.0
        for i in range(1, min(j, ar.shape[1] - 1) + 1):
            psi[:, j] -= ar[:, i] * psi[:, j - i]
    return psi


def extend(y: np.ndarray, ex: np.ndarray, size: np.ndarray, p: int, d: int, q: int, const: np.ndarray,
           phi: np.ndarray, theta: np.ndarray, beta: np.ndarray, horizon: int) -> np.ndarray:
    """(horizon, series) forecasts of a stack whose series end together (zeros before them).
    Regressors stay at their last value; series of at most d values have no forecast."""
    z, x = np.diff(y, n=d, axis=0), np.diff(ex, n=d, axis=0)
    before = len(y) - size
    t = np.arange(len(z))[:, None]
    held = (ex[-1] * beta).sum(1) if d == 0 and len(ex) else 0.0   # differences of a constant are 0
    u = np.where(t >= before, z - (x * beta).sum(-1), 0.0)
    e = u - const
    for i in range(1, p + 1):
        e[i:] -= phi[:, i - 1] * u[:-i]
    e = recur(np.where(t >= before + max(p, q), e, 0.0), theta)
    none = np.zeros((1, len(size)))
    u = np.concatenate([np.repeat(none, p, 0), u])
    e = np.concatenate([np.repeat(none, q, 0), e])
    out = []
    for _ in range(horizon):
        v = const + sum(phi[:, i] * u[-i - 1] for i in range(p)) + sum(theta[:, k] * e[-k - 1] for k in range(q))
        out.append(v)
        u, e = np.concatenate([u[len(u) - p + 1:] if p else u[:0], v[None]]), np.concatenate([e[1:], none])[-max(q, 1):]
    levels = np.array(out) + held
    for k in range(d - 1, -1, -1):   # sum up from the last observed k-th difference
        last = np.diff(y, n=k, axis=0)
        levels = (last[-1] if len(last) else 0.0) + np.cumsum(levels, 0)
    return np.where(size > d, levels, np.nan)


def arima_forecast(df: DataFrame, y: str, t: str, model: DataFrame, keys: Sequence[str] = (),
                   horizon: int = 6, exog: Sequence[str] = ()) -> DataFrame:
    """h-step forecasts with 95 % intervals from ``arima_select`` output.

    The innovations come from the recursion over the whole period series; variances are sums of
    squared psi weights. Exogenous columns are held at their last observed value over the
    horizon. Periods with a null value or regressor take no part; series without a model give no
    rows; models without a variance have null bounds. Output: keys, step, forecast, lower, upper.
    """
    keys, exog = list(keys), list(exog)
    names = ["_y", *_exog(exog)]
    params = ["p", "d", "q", "const", "phi", "theta", "sigma2"] + (["beta"] if exog else [])
    rows = same_keys(packed(df, keys, t, {"_y": y, **_exog(exog)}).select(*keys, *names),
                     model.select(*keys, *[F.col(c).alias(f"_m_{c}") for c in params]), keys)
    schema = schema_of(df, keys, "step int, forecast double, lower double, upper double")

    def step(batch: pa.RecordBatch) -> pa.Table:
        col = lambda c: batch.column(f"_m_{c}")
        values, regressors = Lists(batch.column("_y")), [Lists(batch.column(c)) for c in names[1:]]
        number = lambda c: col(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
        pdq = [number(c).astype(int) for c in ("p", "d", "q")]
        const, sigma2 = number("const"), number("sigma2")
        coefs = {c: Lists(col(c)) for c in ("phi", "theta", *(["beta"] if exog else []))}
        mid, half = np.full((batch.num_rows, horizon), np.nan), np.full((batch.num_rows, horizon), np.nan)
        for at in stacks(values.size, pdq):
            p, d, q = (int(v[at[0]]) for v in pdq)
            v = values.stack(at, end=True)
            if len(v) <= d:
                continue
            phi, theta = coefs["phi"].stack(at).T, coefs["theta"].stack(at).T
            beta = coefs["beta"].stack(at).T if exog else np.zeros((len(at), 0))
            mid[at] = extend(v, _cube(regressors, at, v, True), values.size[at], p, d, q, const[at], phi, theta,
                             beta, horizon).T
            half[at] = Z95 * np.sqrt(sigma2[at][:, None] * np.cumsum(psi_weights(phi, theta, d, horizon) ** 2, 1))
        out = pa.Table.from_batches([batch]).select(keys).take(pa.array(np.repeat(np.arange(batch.num_rows), horizon)))
        steps = pa.array(np.tile(np.arange(1, horizon + 1, dtype=np.int32), batch.num_rows))
        if not keys:
            out = pa.table({"step": steps})
        else:
            out = out.append_column("step", steps)
        for name, v in (("forecast", mid), ("lower", mid - half), ("upper", mid + half)):
            out = out.append_column(name, pa.array(v.ravel(), pa.float64(), from_pandas=True))
        return out

    return per_batch(rows, schema, step)
