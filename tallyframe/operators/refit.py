"""Refitting many series from a mergeable state (Y11).

A series' state is one row: number of observations and the cross products of [1, x.., y]
about a fixed shift (its first mean). States of disjoint observations add up, so an
appended actual costs one small aggregation and one join on the series, whatever the length
of the history; every linear model of the series is solved from its state. Observations
belong to an epoch (a date, a batch number): a state table keeps one row per series and
epoch, and writing an epoch again replaces it, so a replayed batch counts once.

The loop: predictions are compared with the actuals that arrive; where the relative error
exceeds the threshold the series is flagged, and its model is solved anew from the state
that holds everything up to and including the flagged period.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(p: int) -> list[str]:
    """Names of the state's cells: upper triangle of the (p + 2) x (p + 2) cross products."""
    return [f"g_{i}_{j}" for i in range(p + 2) for j in range(i, p + 2)]


def shifts(history: DataFrame, keys: Sequence[str], xcols: Sequence[str], y: str) -> DataFrame:
    """Per series the mean of every column in the first history: the fixed point about which all
    later cross products are taken (keeps them small; any fixed point gives the same models)."""
    return history.groupBy(*keys).agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mu_{i}") for i, c in enumerate([*xcols, y])])


def gram_state(rows: DataFrame, about: DataFrame, keys: Sequence[str], xcols: Sequence[str], y: str,
               epoch: Column | None = None) -> DataFrame:
    """(keys, epoch, g_i_j..) of the observations ``rows``. Rows with a null x or y count nowhere;
    a series that ``about`` does not know starts from shift 0. Partial sums per task come before
    the shuffle, so a series with a third of all rows is as cheap as any."""
    cols = [*xcols, y]
    point = [F.coalesce(F.col(f"mu_{i}"), F.lit(0.0)) for i in range(len(cols))]
    known = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)).join(about, list(keys), "left")
    v = [F.lit(1.0)] + [F.col(c).cast("double") - m for c, m in zip(cols, point)]
    cells = [F.sum(v[i] * v[j]).alias(f"g_{i}_{j}") for i in range(len(v)) for j in range(i, len(v))]
    return known.withColumn("epoch", F.lit(0) if epoch is None else epoch).groupBy(*keys, "epoch").agg(*cells)


def merge_states(states: DataFrame, keys: Sequence[str], p: int) -> DataFrame:
    """One state per series: the sum over its epochs."""
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _columns(p)])


def replace_epochs(states: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``states`` with the rows of ``new`` in place of those of the same series and epoch."""
    return states.join(new.select(*keys, "epoch"), [*keys, "epoch"], "left_anti").unionByName(new)


def _solve(keys: list[str], p: int, alpha: float):
    """States of many series -> their models, solved as one stack of matrices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.num_rows
            g = np.zeros((k, p + 2, p + 2))
            for i in range(p + 2):
                for j in range(i, p + 2):
                    g[:, i, j] = g[:, j, i] = batch.column(f"g_{i}_{j}").to_numpy(zero_copy_only=False)
            mu = np.stack([batch.column(f"mu_{i}").to_numpy(zero_copy_only=False) for i in range(p + 1)], 1)
            n = g[:, 0, 0]
            mean = g[:, 0, 1:] / np.maximum(n, 1)[:, None]
            spread = g[:, 1:, 1:] - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
            scale = np.sqrt(np.maximum(spread[:, range(p), range(p)], 0) / np.maximum(n, 1)[:, None])
            # a feature that does not vary takes no part; the pseudo-inverse leaves it at 0
            scale = np.where(scale > 1e-9 * (1 + np.abs(mu[:, :p])), scale, np.inf)
            a = spread[:, :p, :p] / scale[:, :, None] / scale[:, None, :]
            b = spread[:, :p, p] / scale
            a = a + alpha * np.eye(p)
            coef = np.einsum("kij,kj->ki", np.linalg.pinv(a, rcond=1e-10, hermitian=True), b) / scale
            intercept = mu[:, p] + mean[:, p] - ((mu[:, :p] + mean[:, :p]) * coef).sum(1)
            sse = spread[:, p, p] - 2 * (coef * spread[:, :p, p]).sum(1) + np.einsum("ki,kij,kj->k", coef, spread[:, :p, :p], coef)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keys], pa.array(n.astype(np.int64)), pa.array(intercept),
                 pa.ListArray.from_arrays(np.arange(0, k * p + 1, p, dtype=np.int32), coef.reshape(-1)) if p else pa.array([[]] * k, pa.list_(pa.float64())),
                 pa.array(np.maximum(sse, 0) / np.maximum(n, 1))], [*keys, "n", "intercept", "coef", "mse"])
    return run


def solve_states(states: DataFrame, about: DataFrame, keys: Sequence[str], p: int, alpha: float = 0.0) -> DataFrame:
    """(keys, n, intercept, coef, mse) of the ridge model of every merged state: standardised
    features, penalty ``alpha``, free intercept. Features that do not vary get coefficient 0;
    one observation gives a constant."""
    keys = list(keys)
    types = dict(states.dtypes)
    rows = states.join(about, keys, "left").fillna(0.0, [f"mu_{i}" for i in range(p + 1)])
    return rows.mapInArrow(_solve(keys, p, alpha), ", ".join(
        [*(f"`{c}` {types[c]}" for c in keys), "n long", "intercept double", "coef array<double>", "mse double"]))


def predict(models: DataFrame, rows: DataFrame, keys: Sequence[str], xcols: Sequence[str], name: str = "forecast") -> DataFrame:
    """``rows`` of known series with their model's value."""
    value = F.col("intercept")
    for i, c in enumerate(xcols):
        value = value + F.coalesce(F.col("coef")[i] * F.col(c), F.lit(0.0))
    return rows.join(models, list(keys)).withColumn(name, value).select(*rows.columns, name)


def first_alarm(scored: DataFrame, keys: Sequence[str], t: str, actual: str, forecast: str, threshold: float = 0.15) -> DataFrame:
    """Per series: the first period whose relative error exceeds ``threshold`` (null: none), the mean
    relative error up to it (of all periods where there is none), and the number of periods compared."""
    error = F.try_divide(F.abs(F.col(actual) - F.col(forecast)), F.abs(F.col(actual)))
    rows = scored.withColumn("_e", error)
    flagged = rows.groupBy(*keys).agg(F.min(F.when(F.col("_e") > threshold, F.col(t))).alias("alarm"))
    upto = rows.join(flagged, list(keys)).where(F.col("alarm").isNull() | (F.col(t) <= F.col("alarm")))
    return upto.groupBy(*keys, "alarm").agg(F.avg("_e").alias("mean_error"), F.count("_e").alias("compared"))


def refit_flagged(history: DataFrame, actuals: DataFrame, keys: Sequence[str], t: str, xcols: Sequence[str], y: str,
                  alpha: float = 0.0, threshold: float = 0.15) -> DataFrame:
    """Monitor -> append -> refit for every series of ``history``.

    The model of the history predicts every period of ``actuals``; a flagged series appends its
    actuals up to the alarm to its state and is solved again. Output: keys, n_before,
    intercept_before, coef_before, alarm, mean_error, compared, n, intercept, coef (after).
    Series without actuals or without an alarm keep their model."""
    keys, p = list(keys), len(xcols)
    about = shifts(history, keys, xcols, y)
    state = gram_state(history, about, keys, xcols, y)
    before = solve_states(merge_states(state, keys, p), about, keys, p, alpha)
    alarms = first_alarm(predict(before, actuals, keys, xcols), keys, t, y, "forecast", threshold)
    new = actuals.join(alarms.where(F.col("alarm").isNotNull()).select(*keys, "alarm"), keys).where(F.col(t) <= F.col("alarm"))
    added = gram_state(new, about, keys, xcols, y, F.lit(1))
    after = solve_states(merge_states(replace_epochs(state, added, keys), keys, p), about, keys, p, alpha)
    old = before.select(*keys, F.col("n").alias("n_before"), F.col("intercept").alias("intercept_before"),
                        F.col("coef").alias("coef_before"))
    return (old.join(alarms, keys, "left").join(after.drop("mse"), keys)
            .withColumn("compared", F.coalesce("compared", F.lit(0))))
