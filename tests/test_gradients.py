"""Learners whose loss and gradient are sums over all rows."""

import numpy as np
import pandas as pd
import pytest

from tallyframe.operators import learn


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    x, y, theta = rng.normal(size=(7, 3)), rng.normal(size=7), rng.normal(size=3 * 4 + 4 + 4 + 1)
    got = learn.squared_loss(theta, x, y, 4)
    for i in range(len(theta)):
        nudge = np.zeros(len(theta))
        nudge[i] = 1e-6
        up, down = (learn.squared_loss(theta + s * nudge, x, y, 4)[0] for s in (1, -1))
        assert got[1 + i] == pytest.approx((up - down) / 2e-6, rel=1e-5, abs=1e-6)


def test_parts_of_batches_add_up():
    rng = np.random.default_rng(3)
    x, y, theta = rng.normal(size=(10, 2)), rng.normal(size=10), rng.normal(size=2 * 3 + 3 + 3 + 1)
    whole = learn.squared_loss(theta, x, y, 3)
    parts = learn.squared_loss(theta, x[:4], y[:4], 3) + learn.squared_loss(theta, x[4:], y[4:], 3)
    assert np.allclose(whole, parts)


def _curve(spark, rows=600):
    rng = np.random.default_rng(5)
    x = rng.uniform(-2, 2, (rows, 2))
    y = np.sin(x[:, 0]) + 0.5 * x[:, 1] ** 2
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y})
    return spark.createDataFrame(pdf)


def test_network_fits_and_ignores_the_partitioning(spark):
    df = _curve(spark)
    one, many = (learn.mlp_regressor(df.repartition(n), ["a", "b"], "y", hidden=12, steps=25) for n in (1, 8))
    assert one["loss"] == pytest.approx(many["loss"], rel=1e-4)
    assert np.allclose(one["w1"], many["w1"], rtol=1e-2, atol=1e-3)
    got = learn.mlp_regressor_predict(df, one).toPandas()
    assert ((got.y - got.prediction) ** 2).mean() < 0.1 * got.y.var()


def test_network_holds_a_batch_at_a_time(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    seen = []
    try:
        spark.conf.set(key, "50")
        df = _curve(spark, 500).coalesce(1)

        def part(rows):
            assert len(rows) <= 50
            return np.array([len(rows), rows[:, 2].sum()])

        seen = learn._sum_over_rows(df, part, 2)
    finally:
        spark.conf.set(key, before)
    assert seen[0] == 500 and seen[1] == pytest.approx(df.agg({"y": "sum"}).first()[0])


def test_network_without_rows_and_with_nulls(spark):
    df = _curve(spark, 60)
    gaps = df.union(spark.createDataFrame([(None, 1.0, 2.0), (1.0, float("nan"), 2.0), (1.0, 1.0, None)], df.schema))
    clean, dirty = (learn.mlp_regressor(d.coalesce(1), ["a", "b"], "y", hidden=4, steps=3) for d in (df, gaps))
    assert clean["loss"] == pytest.approx(dirty["loss"]) and np.allclose(clean["mu"], dirty["mu"])
    none = learn.mlp_regressor(df.limit(0), ["a", "b"], "y", hidden=4)
    assert none["loss"] == 0 and none["w1"].shape == (2, 4) and np.isfinite(none["w1"]).all()
    flat = df.selectExpr("1D AS a", "b", "y")
    assert np.isfinite(learn.mlp_regressor(flat, ["a", "b"], "y", hidden=4, steps=3)["loss"])


def _brute_perceptron(x, y, epochs, eta, patience):
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    best, fewest, since = w, None, 0
    for _ in range(epochs):
        wrong = y * (x @ w) <= 0
        if fewest is None or wrong.sum() < fewest:
            best, fewest, since = w, wrong.sum(), 0
        else:
            since += 1
        if not wrong.any() or since >= patience:
            break
        w = w + eta * (y[wrong, None] * x[wrong]).sum(0) / len(x)
    return best


@pytest.mark.parametrize("parts", [1, 8])
def test_perceptron_equals_brute_force(spark, parts):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 2)) + 0.3
    label = (x[:, 0] - x[:, 1] + rng.normal(0, 0.4, 300) > 0).astype(int)      # not separable
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": label})).repartition(parts)
    got = learn.perceptron(df, ["a", "b"], "y", epochs=12, eta=0.5, patience=5).first()
    want = _brute_perceptron(x, np.where(label > 0, 1.0, -1.0), 12, 0.5, 5)
    assert np.allclose([*got.coef, got.intercept], want)
    none = learn.perceptron(df.limit(0), ["a", "b"], "y", epochs=3).first()
    assert none.coef == [0.0, 0.0] and none.epochs == 0
