"""Forecast monitoring as a Structured Streaming job.

Actual observations arrive as a stream; earlier predictions are a static table. Each
micro-batch is matched to the predictions on (entity, 'yyyy-MM') — a stream-static
equi-join, no state — for the relative error and retrain flag (> threshold).
``foreachBatch`` writes every epoch's rows and its (entity -> count, sum) partials to
folders of their own, so a restarted query resumes from its checkpoint and a replayed
epoch replaces what it wrote; the running mean error is the sum over the partials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scored_actuals(actuals: DataFrame, predictions: DataFrame, id_col: str, t_col: str,
                   actual_col: str, pred_col: str, threshold: float = 0.15) -> DataFrame:
    """Stream-static join: each actual with the prediction made for its month."""
    a = actuals.withColumn("ym", F.date_format(t_col, "yyyy-MM"))
    p = predictions.select(id_col, F.date_format(t_col, "yyyy-MM").alias("ym"), pred_col)
    j = a.join(p, [id_col, "ym"], "left")
    err = F.try_divide(F.abs(F.col(actual_col) - F.col(pred_col)), F.abs(F.col(actual_col)))
    return j.withColumn("rel_error", err).withColumn("retrain", F.col("rel_error") > threshold)


def write_epoch(batch: DataFrame, epoch: int, id_col: str, sink_dir: str) -> None:
    """Write one micro-batch of scored actuals and its per-entity partial sums."""
    path = f"{sink_dir}/scored/epoch={epoch}"
    batch.write.mode("overwrite").parquet(path)
    done = batch.sparkSession.read.schema(batch.schema).parquet(path)
    (done.where(F.col("rel_error").isNotNull()).groupBy(id_col)
     .agg(F.count(F.lit(1)).alias("n"), F.sum("rel_error").alias("err_sum"))
     .write.mode("overwrite").parquet(f"{sink_dir}/partials/epoch={epoch}"))


def running_errors(spark: SparkSession, sink_dir: str, id_col: str) -> DataFrame:
    """Per entity: observations, error sum and running mean error over all epochs written."""
    parts = spark.read.parquet(f"{sink_dir}/partials")
    total = parts.groupBy(id_col).agg(F.sum("n").alias("n"), F.sum("err_sum").alias("err_sum"))
    return total.withColumn("running_error", F.col("err_sum") / F.col("n"))


def start_monitor(actuals: DataFrame, predictions: DataFrame, id_col: str, t_col: str, actual_col: str,
                  pred_col: str, sink_dir: str, checkpoint: str, threshold: float = 0.15,
                  watermark: str = "45 days", trigger: dict | None = None):
    """Start the monitor. ``actuals`` is a streaming DataFrame with an event-time column
    ``t_col``; late rows beyond ``watermark`` are dropped by de-duplication state.
    Output folders under ``sink_dir``, one ``epoch=<id>`` folder each per micro-batch:
    ``scored`` (every matched actual) and ``partials`` (per-entity count and error sum).
    A replayed batch overwrites its own folders, so nothing is counted twice and no state
    is rewritten; ``running_errors`` sums the partials."""
    dedup = actuals.withWatermark(t_col, watermark).dropDuplicates([id_col, t_col])
    scored = scored_actuals(dedup, predictions, id_col, t_col, actual_col, pred_col, threshold)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch, epoch, id_col, sink_dir)

    w = scored.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
