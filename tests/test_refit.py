"""Refitting from states against a full refit, replayed epochs, and many series at once."""

import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyframe.operators import refit


def _series(series=6, length=60, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(series):
        x1, x2 = rng.normal(50, 5, length), rng.normal(size=length)
        jump = np.where(np.arange(length) > 48, 60.0 * (s % 2), 0)
        for i, y in enumerate(100 + 2 * x1 - 3 * x2 + jump + rng.normal(0, 0.5, length)):
            rows.append((f"s{s}", i, float(x1[i]), float(x2[i]), float(y)))
    return pd.DataFrame(rows, columns=["s", "t", "x1", "x2", "y"])


def _ridge(part, alpha):
    x, y = part[["x1", "x2"]].to_numpy(), part.y.to_numpy()
    sd = x.std(0)
    z = (x - x.mean(0)) / sd
    coef = np.linalg.solve(z.T @ z + alpha * np.eye(2), z.T @ (y - y.mean())) / sd
    return y.mean() - x.mean(0) @ coef, coef


def test_refit_equals_a_full_refit(spark):
    pdf = _series()
    df = spark.createDataFrame(pdf)
    for alpha in (0.0, 3.0):
        got = refit.refit_flagged(df.where("t < 45"), df.where("t >= 45"), ["s"], "t", ["x1", "x2"], "y", alpha).collect()
        assert len(got) == 6
        for r in got:
            part = pdf[pdf.s == r.s]
            b0, c0 = _ridge(part[part.t < 45], alpha)
            assert np.allclose([r.intercept_before, *r.coef_before], [b0, *c0])
            err = [abs(v.y - (b0 + c0 @ [v.x1, v.x2])) / abs(v.y) for v in part[part.t >= 45].itertuples()]
            alarm = next((45 + i for i, e in enumerate(err) if e > 0.15), None)
            assert r.alarm == alarm and (alarm is None) == (int(r.s[1:]) % 2 == 0)
            b, c = _ridge(part[part.t <= (44 if alarm is None else alarm)], alpha)
            assert np.allclose([r.intercept, *r.coef], [b, *c]) and r.n == (45 if alarm is None else alarm + 1)
            seen = err if alarm is None else err[:alarm - 44]
            assert np.isclose(r.mean_error, np.mean(seen)) and r.compared == len(seen)


def test_a_replayed_epoch_counts_once(spark):
    pdf = _series(2)
    df = spark.createDataFrame(pdf).withColumn("epoch", F.floor(F.col("t") / 20))
    about = refit.shifts(df.where("epoch = 0"), ["s"], ["x1", "x2"], "y")
    part = lambda e: refit.gram_state(df.where(f"epoch = {e}"), about, ["s"], ["x1", "x2"], "y", F.lit(e))
    states = part(0)
    for e in (1, 2, 1):                     # batch 1 arrives twice
        states = refit.replace_epochs(states, part(e), ["s"])
    got = refit.solve_states(refit.merge_states(states, ["s"], 2), about, ["s"], 2).collect()
    for r in got:
        b, c = _ridge(pdf[pdf.s == r.s], 0.0)
        assert r.n == 60 and np.allclose([r.intercept, *r.coef], [b, *c])


def test_edges_of_states(spark):
    rows = [("one", 1, 2.0, 5.0), ("flat", 1, 3.0, 1.0), ("flat", 2, 3.0, 2.0), ("null", 1, None, 1.0), ("null", 2, 1.0, 4.0)]
    df = spark.createDataFrame(rows, "s string, t int, x double, y double")
    got = {r.s: r for r in refit.refit_flagged(df, df.limit(0), ["s"], "t", ["x"], "y").collect()}
    assert {s: (r.n, r.intercept, list(r.coef), r.alarm, r.compared) for s, r in got.items()} == {
        "one": (1, 5.0, [0.0], None, 0), "flat": (2, 1.5, [0.0], None, 0), "null": (1, 4.0, [0.0], None, 0)}
    assert refit.refit_flagged(df.limit(0), df, ["s"], "t", ["x"], "y").collect() == []


def test_many_series_are_solved_in_stacks(spark):
    rows = spark.range(0, 1_000_000, 1, 8).select(
        (F.col("id") % 100_000).alias("s"), F.floor(F.col("id") / 100_000).cast("double").alias("x"))
    rows = rows.withColumn("y", F.col("s") + 2.0 * F.col("x"))
    began = time.time()
    about = refit.shifts(rows, ["s"], ["x"], "y")
    models = refit.solve_states(refit.merge_states(refit.gram_state(rows, about, ["s"], ["x"], "y"), ["s"], 1), about, ["s"], 1)
    bad = models.where((F.abs(F.col("intercept") - F.col("s")) > 1e-6) | (F.abs(F.col("coef")[0] - 2) > 1e-6)).count()
    assert bad == 0 and models.count() == 100_000 and time.time() - began < 60
