import datetime as dt

import numpy as np
import pytest

from tallyframe.operators import forecast, trend

YEARLY = {"yearly": (365.25, 2)}


def _bent(days, slope, at, sd, rng):
    years = days / 365.25
    y = 100 + slope[0] * (years - years[0])
    for a, s in zip(at, slope[1:]):
        y = y + s * np.maximum(days - days[a], 0) / 365.25
    return y + 2 * np.sin(2 * np.pi * days / 365.25) + rng.normal(size=len(days)) * sd


def _plain_objective(y, x, plain, noise, flexibility, w):
    prior = np.r_[np.full(2, 1 / trend.TREND_SD ** 2), np.full(plain - 2, 1 / trend.SEASON_SD ** 2)]
    return ((y - x @ w) ** 2).sum() / 2 + noise / flexibility * np.abs(w[plain:]).sum() \
        + noise / 2 * (prior * w[:plain] ** 2).sum()


def test_two_planted_changepoints():
    rng = np.random.default_rng(1)
    days = np.arange(18000.0, 19000.0)
    y = _bent(days, (10, 40, -70), (310, 620), 1.0, rng)
    m = trend.fit_stack(y[:, None], days[:, None], np.array([1000]), YEARLY)
    bends, knots = m["bends"][0], m["knots"][0] * 365.25 - days[0]
    up, down = bends > 3, bends < -3
    assert abs((bends * knots)[up].sum() / bends[up].sum() - 310) < 45 and abs(bends[up].sum() - 40) < 12
    assert abs((bends * knots)[down].sum() / bends[down].sum() - 620) < 45 and abs(bends[down].sum() + 70) < 15
    assert m["slope"][0] == pytest.approx(10, abs=5) and m["sigma"][0] == pytest.approx(1, rel=0.15)


def test_straight_trend_stays_straight():
    rng = np.random.default_rng(2)
    days = np.arange(18000.0, 18800.0)
    sds = np.array([0.0, 1.0, 3.0])
    y = np.stack([_bent(days, (12,), (), sd, rng) for sd in sds], 1)
    m = trend.fit_stack(y, np.stack([days] * 3, 1), np.full(3, 800), YEARLY)
    years = days[:, None] / 365.25
    line = m["intercept"] + m["slope"] * years + (
        m["bends"] * np.maximum(years[..., None] - m["knots"], 0)).sum(-1)
    # without noise there is no bend; with noise the line moves by a part of it (a straight
    # line's own standard error is 0.07 of the noise at the ends)
    assert np.abs(m["bends"][0]).max() < 1e-3
    off = np.abs(line - (100 + 12 * (years - years[0]))).max(0)
    assert (off <= 1e-3 + 0.3 * sds).all(), off
    assert np.allclose(m["slope"], 12, atol=1.5)


def test_weights_are_least_for_the_stated_objective():
    rng = np.random.default_rng(3)
    n, plain, hinges = 150, 4, 8
    u = np.linspace(0, 1, n)
    x = np.stack([np.ones(n), u, np.sin(9 * u), np.cos(9 * u)]
                 + [np.maximum(u - s, 0) for s in np.linspace(0.1, 0.8, hinges)], 1)
    y = 0.3 + 0.5 * u + 1.5 * np.maximum(u - 0.4, 0) + rng.normal(size=n) * 0.05
    v = np.c_[x, y]
    w, noise = trend.bend((v.T @ v)[None], plain, 0.05)
    assert noise[0] == pytest.approx(((y - x @ w[0]) ** 2).mean(), rel=1e-3)
    best = _plain_objective(y, x, plain, noise[0], 0.05, w[0])
    for _ in range(4000):
        step = rng.normal(size=plain + hinges) * 10 ** rng.uniform(-6, -1) * (rng.random(plain + hinges) < 0.3)
        assert _plain_objective(y, x, plain, noise[0], 0.05, w[0] + step) >= best * (1 - 1e-6)
    assert (w[0][plain:] == 0).any()


def test_series_do_not_touch_each_other(spark):
    rng = np.random.default_rng(4)
    lists = {f"k{i}": _bent(np.arange(18000.0, 18200.0 + 90 * i), (5 * i, 30), (90,), 0.5, rng) for i in range(5)}
    lists["one"] = np.array([4.0])
    start = dt.date(1970, 1, 1) + dt.timedelta(18000)
    rows = [(k, start + dt.timedelta(i), float(v)) for k, ys in lists.items() for i, v in enumerate(ys)]
    rows += [(None, start + dt.timedelta(i), 7.0) for i in range(40)] + [("k1", None, 5.0), ("k1", start, None), ("none", start, None)]
    df = spark.createDataFrame(rows, "s string, t date, y double").repartition(6, "t")
    fit = trend.trend_fit(df, "y", "t", ["s"], YEARLY)
    fit = spark.createDataFrame(fit.collect(), fit.schema)
    got = {r.s: r for r in fit.collect()}
    assert set(got) == {*lists, None}
    for k, y in lists.items():
        days = 18000.0 + np.arange(len(y))
        m = trend.fit_stack(y[:, None], days[:, None], np.array([len(y)]), YEARLY)
        years = days / 365.25
        plain = m["intercept"][0] + m["slope"][0] * years + sum(
            w * c for w, c in zip(m["season"][0], trend.season_columns(days, YEARLY))) \
            + (m["bends"][0] * np.maximum(years[:, None] - m["knots"][0], 0)).sum(1)
        x, names = forecast.fourier_features(df.where(f"s = '{k}'").na.drop(), "t", YEARLY)
        value = [r.v for r in x.join(fit, "s").select("t", trend.trend_value(names).alias("v")).orderBy("t").collect()]
        assert np.allclose(value, plain, rtol=1e-4, atol=0.05) and got[k].n == len(y)
    assert got[None].explained_variance is None and got[None].n == 40 and got["one"].n == 1
    assert trend.trend_fit(df.limit(0), "y", "t", ["s"], YEARLY).count() == 0
    assert trend.trend_fit(df.limit(0), "y", "t", [], YEARLY).count() == 0
