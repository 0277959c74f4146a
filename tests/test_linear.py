import numpy as np
import pandas as pd
import pytest

from tallyframe.operators import linear


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 120
    x1 = rng.normal(1000, 50, n)
    x2 = rng.normal(3, 1, n)
    x3 = rng.integers(0, 2, n).astype(float)
    y = 5 + 0.3 * x1 - 2 * x2 + 4 * x3 + rng.normal(0, 1, n)
    pdf = pd.DataFrame({"k": "s", "t": np.arange(n), "x1": x1, "x2": x2, "x3": x3, "y": y})
    return pdf, spark.createDataFrame(pdf)


def _ridge_np(X, y, alpha, scale):
    mx, my = X.mean(0), y.mean()
    Z = (X - mx) / scale
    b = np.linalg.solve(Z.T @ Z + alpha * np.eye(X.shape[1]), Z.T @ (y - my))
    coef = b / scale
    return my - coef @ mx, coef


def test_ridge_alpha_zero_is_ols(data):
    pdf, df = data
    r = linear.ridge_fit(df, "y", ["x1", "x2", "x3"], ["k"], alpha=0.0).first()
    X = np.column_stack([np.ones(len(pdf)), pdf[["x1", "x2", "x3"]]])
    beta = np.linalg.lstsq(X, pdf.y, rcond=None)[0]
    assert np.allclose([r.intercept, *r.coef], beta, rtol=1e-7, atol=1e-7)


def test_ridge_standardised_penalty(data):
    pdf, df = data
    r = linear.ridge_fit(df, "y", ["x1", "x2", "x3"], ["k"], alpha=10.0, standardize=["x1", "x2"]).first()
    X = pdf[["x1", "x2", "x3"]].to_numpy()
    scale = np.array([X[:, 0].std(), X[:, 1].std(), 1.0])
    b0, coef = _ridge_np(X, pdf.y.to_numpy(), 10.0, scale)
    assert np.allclose([r.intercept, *r.coef], [b0, *coef], rtol=1e-7)


def test_ridge_cv_matches_brute_force(data):
    pdf, df = data
    alphas = list(np.logspace(-3, 3, 7))
    r = linear.ridge_cv(df, "y", ["x1", "x2"], "t", ["k"], alphas=alphas, scheme="kfold", folds=5).first()
    X, y = pdf[["x1", "x2"]].to_numpy(), pdf.y.to_numpy()
    scale = X.std(0)
    folds = np.array_split(np.arange(len(y)), 5)
    scores = []
    for a in alphas:
        s = []
        for f in folds:
            tr = np.setdiff1d(np.arange(len(y)), f)
            b0, coef = _ridge_np(X[tr], y[tr], a, scale)
            s.append(-np.mean((y[f] - b0 - X[f] @ coef) ** 2))
        scores.append(np.mean(s))
    assert r.best_alpha == alphas[int(np.argmax(scores))]
    assert abs(r.best_score - max(scores)) < 1e-6 * abs(max(scores))


def test_vif_matches_inverse_correlation(data):
    pdf, df = data
    v = {r.feature: r.vif for r in linear.vif(df, ["x1", "x2", "x3"], ["k"]).collect()}
    want = np.diag(np.linalg.inv(np.corrcoef(pdf[["x1", "x2", "x3"]].to_numpy().T)))
    assert np.allclose([v["x1"], v["x2"], v["x3"]], want)


def test_poly_trend_matches_polyfit(data):
    pdf, df = data
    got = linear.poly_trend(df, "y", "t", 3, ["k"]).orderBy("t").toPandas()
    idx = np.arange(1, len(pdf) + 1)
    want = np.polyval(np.polyfit(idx, pdf.y, 3), idx)
    assert np.allclose(got.trend, want, rtol=1e-6)


def test_metrics_and_splits(spark, data):
    pdf, df = data
    from pyspark.sql import functions as F
    m = linear.regression_metrics(df.withColumn("p", F.col("y") + 1), "y", "p").first()
    assert abs(m.mae - 1) < 1e-9 and abs(m.rmse - 1) < 1e-9
    s = linear.temporal_split(df, "t", ["k"]).where("is_test").count()
    assert s == int(0.2 * len(pdf))
    r = linear.random_split(df, "t").where("is_test").count()
    assert 0 < r < len(pdf)


def test_coo_matmul(spark):
    A = np.arange(6, dtype=float).reshape(2, 3)
    B = np.arange(12, dtype=float).reshape(3, 4)
    a = spark.createDataFrame([(i, k, float(A[i, k])) for i in range(2) for k in range(3)], "i int, k int, a double")
    b = spark.createDataFrame([(k, j, float(B[k, j])) for k in range(3) for j in range(4)], "k int, j int, b double")
    got = {(r.i, r.j): r.value for r in linear.coo_matmul(a, b).collect()}
    C = A @ B
    assert all(got[(i, j)] == C[i, j] for i in range(2) for j in range(4))


def test_ridge_cv_timeseries_r2_matches_brute_force(data):
    pdf, df = data
    alphas = list(np.logspace(-3, 3, 9))
    r = linear.ridge_cv(df, "y", ["x1", "x2", "x3"], "t", ["k"], alphas=alphas, scheme="timeseries", folds=3,
                        scoring="r2", standardize=["x1", "x2"]).first()
    X, y = pdf[["x1", "x2", "x3"]].to_numpy(), pdf.y.to_numpy()
    scale = np.array([X[:, 0].std(), X[:, 1].std(), 1.0])
    n, s = len(y), min(3, len(y) // 2)
    test = n // (s + 1)
    starts = [n - (s - i) * test for i in range(s)]
    scores = []
    for a in alphas:
        r2 = []
        for st in starts:
            tr, te = np.arange(st), np.arange(st, st + test)
            b0, coef = _ridge_np(X[tr], y[tr], a, scale)
            res = y[te] - b0 - X[te] @ coef
            r2.append(1 - (res ** 2).sum() / ((y[te] - y[te].mean()) ** 2).sum())
        scores.append(np.mean(r2))
    assert r.best_alpha == alphas[int(np.argmax(scores))]
    assert abs(r.best_score - max(scores)) < 1e-8
