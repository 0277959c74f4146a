"""Series joins: merge on date, enrich base rows, prediction lookup / monitoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import ffill_bfill


def merge_series(series: Sequence[DataFrame], on: str, fill: bool = True) -> DataFrame:
    """Chain of full outer equi-joins on ``on`` (one value column each), then forward
    fill and back fill every value column in ``on`` order.

    The inputs are period series (one row per date), so the fill window is
    calendar-bounded."""
    out = series[0]
    for s in series[1:]:
        out = out.join(s, on, "full")
    if fill:
        vals = [c for c in out.columns if c != on]
        out = ffill_bfill(out, vals, on)
    return out


def enrich(base: DataFrame, rates: DataFrame, on: str) -> DataFrame:
    """Left join of base rows with rate rows, rates limited to the base's [min, max] of
    ``on`` (the range is one aggregate row, attached by a broadcast cross join)."""
    rng = base.agg(F.min(on).alias("_lo"), F.max(on).alias("_hi"))
    r = rates.crossJoin(F.broadcast(rng)).where(F.col(on).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")
    return base.join(r, on, "left")


def monitor(actual: DataFrame, predicted: DataFrame, id_col: str, t_col: str, actual_col: str,
            pred_col: str, threshold: float = 0.15) -> DataFrame:
    """Actual vs. earlier prediction matched on (id, 'yyyy-MM'): relative error, retrain
    flag when it exceeds ``threshold``, running mean error per id."""
    a = actual.select(id_col, F.date_format(t_col, "yyyy-MM").alias("ym"), actual_col)
    p = predicted.select(id_col, F.date_format(t_col, "yyyy-MM").alias("ym"), pred_col)
    j = a.join(p, [id_col, "ym"], "left")
    err = F.try_divide(F.abs(F.col(actual_col) - F.col(pred_col)), F.abs(F.col(actual_col)))
    j = j.withColumn("rel_error", err).withColumn("retrain", F.col("rel_error") > threshold)
    w = Window.partitionBy(id_col).orderBy("ym").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.withColumn("running_error", F.avg("rel_error").over(w))


def append_actuals(history: DataFrame, actuals: DataFrame, id_col: str, t_col: str) -> DataFrame:
    """Add newly observed periods to a history table (by column name); a period already
    present is replaced by the new observation (anti join, then union)."""
    kept = history.join(actuals.select(id_col, t_col), [id_col, t_col], "left_anti")
    return kept.unionByName(actuals, allowMissingColumns=True)
