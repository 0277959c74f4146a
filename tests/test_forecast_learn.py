import datetime as dt

import numpy as np
import pandas as pd

from tallyframe.operators import forecast, learn


def _ar1(spark, phi=0.7, n=200, seed=2):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    for i in range(1, n):
        y[i] = 10 + phi * (y[i - 1] - 10) + rng.normal()
    y[0] = 10
    months = [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(n)]
    return spark.createDataFrame(pd.DataFrame({"s": "x", "month": months, "y": y}))


def test_arima_recovers_ar1(spark):
    m = forecast.arima_select(_ar1(spark), "y", "month", ["s"], max_p=2, max_d=1, max_q=2).first()
    assert m.d == 0 and m.p >= 1
    if m.p == 1 and m.q == 0:
        assert abs(m.phi[0] - 0.7) < 0.15


def test_forecast_reverts_to_mean_and_widens(spark):
    df = _ar1(spark)
    m = forecast.arima_select(df, "y", "month", ["s"], max_p=1, max_d=0, max_q=0)
    f = forecast.arima_forecast(df, "y", "month", m, ["s"], horizon=24).orderBy("step").toPandas()
    width = (f.upper - f.lower).to_numpy()
    assert (np.diff(width) >= -1e-9).all()
    assert abs(f.forecast.iloc[-1] - 10) < 1.5


def test_fallback_growth(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 100.0), ("a", dt.date(2024, 2, 1), 200.0)],
                               "s string, month date, y double")
    f = forecast.fallback_forecast(df, "y", "month", ["s"], horizon=3).orderBy("step").collect()
    assert [r.forecast for r in f] == [200.0, 202.0, 204.0]
    assert f[0].month_end == dt.date(2024, 3, 31)


def test_stationarity_flags(spark):
    st = forecast.stationarity(_ar1(spark, 0.3), "y", "month", ["s"]).first()
    assert st.stationary is True


def test_perceptron_separable(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (400, 2))
    lab = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": lab})).repartition(4)
    model = learn.perceptron(df, ["a", "b"], "y", epochs=100)
    acc = learn.linear_predict(df, ["a", "b"], model).selectExpr("avg(cast(prediction = y as double))").first()[0]
    assert acc > 0.95


def test_classification_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "actual int, predicted int")
    r = {x.cls: x for x in learn.classification_report(df, "actual", "predicted").collect()}
    assert r[1].precision == 1.0 and r[1].recall == 0.5 and abs(r[0].precision - 2 / 3) < 1e-12
    assert r[0].accuracy == 0.75


def test_mini_net_deterministic():
    x = np.array([[0.1, 0.2, 0.3], [0.5, 0.5, 0.5]])
    y = np.array([[0.3], [0.6]])
    a = learn.apply_networks(x[None], *learn.train_networks(x[None], y.reshape(1, -1), np.full((1, len(x)), 1 / len(x)), 50, 0.04))[0][:, None]
    b = learn.apply_networks(x[None], *learn.train_networks(x[None], y.reshape(1, -1), np.full((1, len(x)), 1 / len(x)), 50, 0.04))[0][:, None]
    assert np.array_equal(a, b)


def test_arima_with_exogenous_regressor(spark):
    rng = np.random.default_rng(4)
    n = 240
    x = rng.normal(0, 1, n).cumsum()
    e = np.zeros(n)
    for i in range(1, n):
        e[i] = 0.5 * e[i - 1] + rng.normal(0, 0.5)
    y = 3.0 * x + e
    months = [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(n)]
    df = spark.createDataFrame(pd.DataFrame({"s": "a", "month": months, "y": y, "x": x}))
    m = forecast.arima_select(df, "y", "month", ["s"], max_p=1, max_d=0, max_q=0, exog=["x"]).first()
    assert (m.p, m.d, m.q) == (1, 0, 0)
    assert abs(m.beta[0] - 3.0) < 0.1 and abs(m.phi[0] - 0.5) < 0.15
    f = forecast.arima_forecast(df, "y", "month", forecast.arima_select(
        df, "y", "month", ["s"], max_p=1, max_d=0, max_q=0, exog=["x"]), ["s"], horizon=3, exog=["x"]).collect()
    assert len(f) == 3 and abs(f[-1].forecast - 3.0 * x[-1]) < 3.0


def test_fourier_forecast_continues_the_series(spark):
    days = pd.date_range("2022-01-01", periods=900)
    n = np.arange(900)
    origin = (days - pd.Timestamp("1970-01-01")).days.to_numpy()
    wave = lambda o: 50 + 0.02 * (o - origin[0]) + 4 * np.sin(2 * np.pi * o / 365.25)
    noise = np.random.default_rng(4).normal(0, 0.5, 900)
    pdf = pd.DataFrame({"k": "a", "t": days.date, "y": wave(origin) + noise})
    few = pd.DataFrame({"k": "b", "t": days.date[:5], "y": np.arange(5.0)})
    df = spark.createDataFrame(pd.concat([pdf, few]), "k string, t date, y double")
    got = forecast.fourier_forecast(df, "y", "t", ["k"], horizon=20).orderBy("step").toPandas()
    assert list(got.k.unique()) == ["a"] and len(got) == 20
    want = wave(origin[-1] + 1 + np.arange(20))
    assert np.abs(got.forecast - want).max() < 0.4
    assert np.allclose(got.upper - got.lower, 2 * 1.28155 * 0.5, rtol=0.1)
    assert (pd.to_datetime(got.t).to_numpy() == pd.date_range(days[-1] + pd.Timedelta(days=1), periods=20).to_numpy()).all()
    assert forecast.fourier_forecast(df, "y", "t", ["k"], freq="M").count() == 0
