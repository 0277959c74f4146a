import math

import numpy as np
import pandas as pd
import pytest

from tallyframe.operators import arima, forecast, series


def _arma(rng, n, phi, theta, mean=0.0, sd=1.0):
    e = rng.normal(size=n + 60) * sd
    y = np.zeros(n + 60)
    for i in range(1, n + 60):
        y[i] = phi * y[i - 1] + e[i] + theta * e[i - 1]
    return y[60:] + mean


def _plain_errors(z, const, phi, theta, first):
    e = np.zeros(len(z))
    for i in range(first, len(z)):
        e[i] = z[i] - const - sum(f * z[i - k - 1] for k, f in enumerate(phi)) \
            - sum(h * e[i - k - 1] for k, h in enumerate(theta) if i > k)
    return e


def _plain_forecast(y, p, d, q, const, phi, theta, h):
    z = np.diff(y, n=d)
    e = _plain_errors(z, const, phi, theta, max(p, q))
    z, e = list(z), list(e)
    for _ in range(h):
        z.append(const + sum(phi[k] * z[-k - 1] for k in range(p)) + sum(theta[k] * e[-k - 1] for k in range(q)))
        e.append(0.0)
    out = np.array(z[-h:])
    for k in range(d - 1, -1, -1):
        out = np.diff(y, n=k)[-1] + np.cumsum(out)
    return out


def _frame(spark, lists):
    rows = [(k, i, float(v)) for k, ys in lists.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "s string, t int, y double").repartition(5, "t")


def test_refined_fit_is_closer_than_its_start():
    rng = np.random.default_rng(4)
    phi, theta, many, n = 0.5, 0.8, 80, 250
    y = np.stack([_arma(rng, n, phi, theta, 40, 3) for _ in range(many)], 1)
    s = arima.Stack(y, np.zeros((n, many, 0)), np.full(many, n), 0, 0, 1)
    p, q, start = next(s.starts(1, 1, 6, [(1, 1)]))
    par, rss = s.descend(start, 1, 1)
    before, after = s.units(start, 1, 1), s.units(par, 1, 1)
    e0 = np.where(s.mask, s.errors(start, 1, 1), 0)
    assert (rss <= (e0 ** 2).sum(0) + 1e-12).all() and (rss < (e0 ** 2).sum(0) * 0.9999).mean() > 0.5
    miss = lambda u: np.sqrt((u[1][:, 0] - phi) ** 2 + (u[2][:, 0] - theta) ** 2).mean()
    assert miss(after) < 0.9 * miss(before)
    # least sum: nothing lower in any direction nearby, by the plain recursion in data units
    c, f, h = (after[0][3], after[1][3], after[2][3])
    best = (_plain_errors(y[:, 3], c, f, h, 1) ** 2).sum()
    assert best == pytest.approx(rss[3] * s.scale[3] ** 2, rel=1e-9)
    for dc, df, dh in ((.01, 0, 0), (-.01, 0, 0), (0, .002, 0), (0, -.002, 0), (0, 0, .002), (0, 0, -.002)):
        assert (_plain_errors(y[:, 3], c + dc, f + df, h + dh, 1) ** 2).sum() > best


def test_slopes_are_the_derivatives():
    rng = np.random.default_rng(5)
    y, x = rng.normal(size=(60, 4)).cumsum(0), rng.normal(size=(60, 4, 2))
    size = np.array([60, 44, 60, 31])
    for d in (0, 1):
        s = arima.Stack(y, x, size, d, 1, 2)
        par = rng.normal(size=(4, s.const + 6)) * 0.3
        slopes = s.slopes(par, s.errors(par, 2, 2), 2, 2)
        for k in range(par.shape[1]):
            step = np.zeros_like(par)
            step[:, k] = 1e-6
            numeric = (s.errors(par + step, 2, 2) - s.errors(par - step, 2, 2)) / 2e-6
            assert np.abs(np.where(s.mask, numeric - slopes[..., k], 0)).max() < 1e-6


def test_orders_do_not_depend_on_the_other_series(spark):
    rng = np.random.default_rng(6)
    lists = {f"k{i}": _arma(rng, 30 + 17 * i, 0.6, 0.3, 5 * i) for i in range(6)}
    lists["walk"] = rng.normal(size=120).cumsum()
    got = {r.s: r for r in arima.arima_select(_frame(spark, lists), "y", "t", ["s"]).collect()}
    assert set(got) == set(lists) and got["walk"].d == 1
    for k, ys in lists.items():
        alone = arima.best_orders(ys[:, None], np.zeros((len(ys), 1, 0)), np.array([len(ys)]), 2, 1, 2, 6, (1, 0, 1))[0]
        r = got[k]
        assert (r.p, r.d, r.q, r.n_eff) == (alone["p"], alone["d"], alone["q"], alone["n_eff"])
        assert r.aic == pytest.approx(alone["aic"], abs=1e-5)
        assert np.allclose([*r.phi, *r.theta], [*alone["phi"], *alone["theta"]], atol=1e-3)
        e = _plain_errors(np.diff(ys, n=r.d), r.const, r.phi, r.theta, 3 - r.d)
        assert r.sigma2 == pytest.approx((e ** 2).sum() / r.n_eff, rel=1e-6)


def test_forecasts_against_the_plain_recursion(spark):
    rng = np.random.default_rng(7)
    lists = {"a": _arma(rng, 50, 0.5, 0.4, 9), "b": rng.normal(size=33).cumsum(),
             "c": rng.normal(size=70).cumsum().cumsum(), "d": _arma(rng, 20, -0.4, 0.0), "tiny": [1.0], "no_model": [1.0, 2.0]}
    models = {"a": (1, 0, 1, 2.0, [0.5], [0.4]), "b": (0, 1, 2, 0.0, [], [0.3, -0.2]),
              "c": (2, 2, 1, 0.0, [0.2, 0.1], [-0.5]), "d": (2, 0, 0, 0.3, [-0.4, 0.1], []), "tiny": (0, 1, 1, 0.0, [], [0.1])}
    m = spark.createDataFrame([(k, *v, 4.0) for k, v in models.items()],
                              "s string, p int, d int, q int, const double, phi array<double>, theta array<double>, sigma2 double")
    got = arima.arima_forecast(_frame(spark, lists), "y", "t", m, ["s"], horizon=5).orderBy("s", "step").toPandas()
    assert len(got) == 5 * len(models)
    for k, (p, d, q, c, phi, theta) in models.items():
        part = got[got.s == k]
        if k == "tiny":
            assert part.forecast.isna().all()
            continue
        assert np.allclose(part.forecast, _plain_forecast(np.asarray(lists[k]), p, d, q, c, phi, theta, 5))
    a = got[got.s == "a"]
    psi = np.array([1, .9, .45, .225, .1125])
    assert np.allclose(a.upper - a.lower, 2 * arima.Z95 * 2 * np.sqrt(np.cumsum(psi ** 2)))


def test_defined_results_at_the_edges(spark):
    nothing = spark.createDataFrame([], "s string, t int, y double")
    assert arima.arima_select(nothing, "y", "t", ["s"]).count() == 0
    assert arima.arima_select(nothing, "y", "t").count() == 0
    assert forecast.stationarity(nothing, "y", "t", ["s"], lags=None).count() == 0
    rng = np.random.default_rng(8)
    y = _arma(rng, 60, 0.5, 0)
    rows = [(None, i, float(v)) for i, v in enumerate(y)] + [(None, 1000, None), (None, None, 3.0)]
    rows += [("flat", i, 0.1) for i in range(50)] + [("short", 0, 2.0), ("empty", 0, None)]
    df = spark.createDataFrame(rows, "s string, t int, y double")
    m = arima.arima_select(df, "y", "t", ["s"])
    got = {r.s: r for r in m.collect()}
    assert set(got) == {None, "flat", "short", "empty"} and got[None].n_eff == 57
    for k in ("flat", "short", "empty"):
        assert (got[k].p, got[k].d, got[k].q) == (1, 0, 1) and got[k].aic is None and got[k].sigma2 is None
    f = {(r.s, r.step): r for r in arima.arima_forecast(df, "y", "t", m, ["s"], horizon=2).collect()}
    assert f[(None, 1)].forecast is not None and f[("flat", 1)].lower is None and len(f) == 8
    st = {r.s: r for r in forecast.stationarity(df, "y", "t", ["s"], lags=None).collect()}
    assert st["flat"].adf_stat is None and st["short"].stationary is None and st["empty"].n == 0


def test_regressors_and_errors_are_fitted_together(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=160).cumsum()
    y = 4 + 2.5 * x + _arma(rng, 160, 0.7, 0, 0, 0.5)
    df = spark.createDataFrame(pd.DataFrame({"t": range(160), "x": x, "y": y}))
    r = arima.arima_select(df, "y", "t", exog=["x"], max_p=1, max_d=0, max_q=0).first()
    assert r.p == 1 and abs(r.phi[0] - 0.7) < 0.15 and abs(r.beta[0] - 2.5) < 0.15


def _plain_adf(y, lags, first):
    dy = np.diff(y)
    rows = range(first, len(dy))
    x = np.array([[1.0, y[i], *[dy[i - k] for k in range(1, lags + 1)]] for i in rows])
    z = np.array([dy[i] for i in rows])
    b, *_ = np.linalg.lstsq(x, z, rcond=None)
    rss = ((z - x @ b) ** 2).sum()
    se = math.sqrt(rss / (len(z) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    return b[1] / se, len(z) * math.log(rss / len(z)) + 2 * x.shape[1]


def test_dickey_fuller_lags_by_aic(spark):
    rng = np.random.default_rng(10)
    lists = {f"w{i}": rng.normal(size=40 + 25 * i).cumsum() + 1e4 for i in range(5)}
    lists.update({f"a{i}": _arma(rng, 50 + 30 * i, 0.5, 0.7, -300) for i in range(5)})
    got = {r.s: r for r in forecast.stationarity(_frame(spark, lists), "y", "t", ["s"], lags=None).collect()}
    for k, y in lists.items():
        limit = min(math.ceil(12 * (len(y) / 100) ** 0.25), len(y) // 2 - 2)
        best = min(range(limit + 1), key=lambda j: _plain_adf(y, j, limit)[1])
        assert got[k].df_lags == best and got[k].df_n == len(y) - 1 - best
        assert got[k].adf_stat == pytest.approx(_plain_adf(y, best, best)[0], rel=1e-6)
    assert any(got[k].df_lags > 0 for k in lists)


def test_p_values_at_the_published_critical_values(spark):
    crit = {"0.01": -3.43035, "0.05": -2.86154, "0.10": -2.56677}
    df = spark.createDataFrame([(float(p), v) for p, v in crit.items()], "p double, x double")
    for r in df.selectExpr("p", forecast.df_p_value_sql("x") + " AS got").collect():
        assert r.got == pytest.approx(r.p, rel=0.03)
    edge = spark.createDataFrame([(-30.0,), (3.0,)], "x double").selectExpr(forecast.df_p_value_sql("x") + " AS p")
    assert [r.p for r in edge.collect()] == [0.0, 1.0]


def test_many_series_without_a_call_each(spark):
    from pyspark.sql import functions as F
    df = spark.range(100_000 * 24).select((F.col("id") % 100_000).alias("s"), F.floor(F.col("id") / 100_000).alias("t"),
                                          (F.hash("id") % 1000 / 100.0).alias("y"))
    r = arima.arima_select(df, "y", "t", ["s"], max_p=1, max_d=1, max_q=1).agg(
        F.count("*").alias("n"), F.count("aic").alias("fitted")).first()
    assert r.n == 100_000 and r.fitted == 100_000


def test_stacks_hold_every_row_once():
    size = np.array([5, 0, 70000, 3, 90000, 90000, 4, 0])
    parts = list(series.stacks(size))
    assert sorted(np.concatenate(parts)) == list(range(8))
    assert all(len(p) * size[p].max() <= series.STACK or len(p) == 1 for p in parts)
    assert list(series.stacks(np.zeros(0, int))) == []
