import numpy as np
import pandas as pd
import pytest

from tallyframe.operators import ranks, stats


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.gamma(2.0, 3.0, 400), 3)
    g = np.where(np.arange(400) % 3 == 0, "hot", "cold")
    pdf = pd.DataFrame({"g": g, "x": x})
    return pdf, spark.createDataFrame(pdf)


def test_sorted_quantiles_match_numpy(values):
    pdf, df = values
    q = {r.g: r for r in stats.quantiles(df, "x", [0.1, 0.25, 0.5, 0.9], ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        want = np.percentile(part.x, [10, 25, 50, 90])
        assert np.allclose([q[g].q10, q[g].q25, q[g].q50, q[g].q90], want)


def test_quantiles_partition_invariant(spark, values):
    pdf, df = values
    a = stats.quantiles(df.repartition(1), "x", [0.5], ["g"]).orderBy("g").collect()
    b = stats.quantiles(df.repartition(16), "x", [0.5], ["g"]).orderBy("g").collect()
    assert a == b


def test_group_positions_is_a_permutation(values):
    pdf, df = values
    p = ranks.group_positions(df, ["g"], "x", "pos", "n").toPandas()
    for g, part in p.groupby("g"):
        assert sorted(part.pos) == list(range(1, len(part) + 1))
        assert (part.sort_values("pos").x.diff().dropna() >= 0).all()


def test_histogram_max_in_last_bin_and_counts_sum(values):
    pdf, df = values
    h = stats.histogram(df, "x", 10).orderBy("bin").collect()
    assert len(h) == 10 and sum(r["count"] for r in h) == len(pdf)
    assert h[-1]["cum_count"] == len(pdf)
    counts, _ = np.histogram(pdf.x, bins=10)
    assert [r["count"] for r in h] == list(counts)


def test_shape_matches_pandas(values):
    pdf, df = values
    s = {r.g: r for r in stats.shape(df, "x", ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert abs(s[g].skewness - part.x.skew()) < 1e-9
        assert abs(s[g].kurtosis - part.x.kurt()) < 1e-9
        assert abs(s[g].median - part.x.median()) < 1e-12


def test_box_stats_whiskers(values):
    pdf, df = values
    b = stats.box_stats(df, "x").first()
    q1, q3 = np.percentile(pdf.x, [25, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert b.whisker_high == pdf.x[pdf.x <= hi].max()
    assert b.whisker_low == pdf.x[pdf.x >= lo].min()
    assert b.outliers == int(((pdf.x < lo) | (pdf.x > hi)).sum())


def test_kde_matches_direct_sum(values):
    pdf, df = values
    k = stats.kde(df, "x", 20).orderBy("point").collect()
    x = pdf.x.to_numpy()
    h = len(x) ** -0.2 * x.std(ddof=1)
    grid = np.linspace(x.min(), x.max(), 20)
    want = [np.exp(-0.5 * ((g - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi)) for g in grid]
    assert np.allclose([r.density for r in k], want)


def test_shapiro_normal_vs_uniform(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": ["norm"] * 300 + ["unif"] * 300,
                        "x": np.concatenate([rng.normal(10, 2, 300), rng.uniform(0, 1, 300)])})
    s = {r.g: r for r in stats.shapiro_wilk(spark.createDataFrame(pdf), "x", ["g"]).collect()}
    assert s["norm"].W > 0.99 and s["norm"].p_value > 0.05 and s["norm"].verdict == "normal"
    assert s["unif"].W < 0.97 and s["unif"].p_value < 0.01


def test_value_counts_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    r = {x.k: x for x in stats.value_counts(df, "k").collect()}
    assert r["a"]["count"] == 2 and abs(r["a"].share_pct - 200 / 3) < 1e-9


def test_describe_strings_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "k string")
    r = stats.describe_strings(df, ["k"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)


def test_qq_points_fit(spark):
    rng = np.random.default_rng(11)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.normal(5, 2, 500)}))
    q = stats.qq_points(df, "x").select("slope", "intercept", "r").first()
    assert abs(q.slope - 2) < 0.25 and abs(q.intercept - 5) < 0.25 and q.r > 0.99


def test_kde_per_group_with_null_key_and_constant_group(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=200)
    rows = [(None, float(v)) for v in x] + [("c", 2.0)] * 4 + [("a", float(v) * 3) for v in x]
    df = spark.createDataFrame(rows, "k string, x double")
    got = stats.kde(df, "x", 10, ["k"]).orderBy("point").collect()
    for key, data in ((None, x), ("a", x * 3)):
        h = len(data) ** -0.2 * data.std(ddof=1)
        want = [np.exp(-0.5 * ((g - data) / h) ** 2).sum() / (len(data) * h * np.sqrt(2 * np.pi))
                for g in np.linspace(data.min(), data.max(), 10)]
        assert np.allclose([r.density for r in got if r.k == key], want)
    assert [r.density for r in got if r.k == "c"] == [None] * 10
