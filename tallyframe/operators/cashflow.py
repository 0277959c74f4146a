"""Per-entity cash-flow metrics over month-end rows (output of ``monthly_cash_flow``).

All windows here run over month-end rows partitioned by entity, so a partition holds
at most the months an entity spans: the calendar bounds it, whatever the raw row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import band, clip, exact_mean

EPS = 1e-9  # added to every income denominator, as the reference metrics do


def _ratios(income_mean, saving_mean, essential_mean, income_std):
    inc = income_mean + F.lit(EPS)
    return {
        "saving_ratio": clip(saving_mean / inc * 100, 0, 100),
        "essential_ratio": clip(essential_mean / inc * 100, 0, 100),
        "stability": clip(F.lit(100) - income_std / inc * 100, 0, 100),
    }


def trailing_metrics(monthly: DataFrame, id_col: str = "entity_id", t_col: str = "month_end",
                     days: int = 90) -> DataFrame:
    """Mean income/saving/essential spend over the trailing ``days`` (inclusive) per entity,
    plus clipped saving ratio %, essential ratio % and stability = 100 - CV%.

    An entity without dates uses all its rows. A one-row window has NULL stability
    (sample std undefined).
    """
    w = Window.partitionBy(id_col)
    last = F.max(t_col).over(w)
    recent = monthly.withColumn("_last", last).where(
        F.col("_last").isNull() | (F.col(t_col) >= F.date_sub("_last", days)))
    g = recent.groupBy(id_col).agg(
        F.avg("income").alias("income_mean"), F.avg("saving").alias("saving_mean"),
        F.avg("essential_spend").alias("essential_mean"), F.stddev_samp("income").alias("income_std"),
        F.count(F.lit(1)).alias("months"))
    r = _ratios(F.col("income_mean"), F.col("saving_mean"), F.col("essential_mean"), F.col("income_std"))
    return g.select(id_col, "months", "income_mean", "saving_mean",
                    r["saving_ratio"].alias("saving_ratio"),
                    r["essential_ratio"].alias("essential_ratio"),
                    r["stability"].alias("stability"))


def block_features(monthly: DataFrame, id_col: str = "entity_id", t_col: str = "month_end",
                   rows_per_block: int = 15) -> DataFrame:
    """Split each entity's date-ordered rows into k = max(n div 15, 1) contiguous,
    near-equal blocks (the first n mod k blocks get one extra row) and compute per block
    the three clipped ratios and the training target
    ``(0.5*saving + 0.3*(100 - essential) + 0.2*stability) / 100``.
    """
    w = Window.partitionBy(id_col).orderBy(t_col)
    x = (monthly
         .withColumn("_r", F.row_number().over(w) - 1)
         .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(id_col))))
    k = F.greatest(F.floor(F.col("_n") / rows_per_block), F.lit(1))
    q = F.floor(F.col("_n") / k)
    rem = F.col("_n") - q * k
    big = rem * (q + 1)  # rows covered by the larger blocks
    block = F.when(F.col("_r") < big, F.floor(F.col("_r") / (q + 1))).otherwise(
        rem + F.floor((F.col("_r") - big) / q))
    g = x.withColumn("block", block.cast("int")).groupBy(id_col, "block").agg(
        F.avg("income").alias("_inc"), F.avg("saving").alias("_sav"),
        F.avg("essential_spend").alias("_ess"), F.stddev_samp("income").alias("_std"))
    r = _ratios(F.col("_inc"), F.col("_sav"), F.col("_ess"), F.col("_std"))
    out = g.select(id_col, "block", r["saving_ratio"].alias("saving_ratio"),
                   r["essential_ratio"].alias("essential_ratio"), r["stability"].alias("stability"))
    target = (F.col("saving_ratio") * 0.5 + (F.lit(100) - F.col("essential_ratio")) * 0.3
              + F.col("stability") * 0.2) / 100
    return out.withColumn("target", target)


# Income bands (lower inclusive, upper exclusive) and their labels.
INCOME_BANDS = [(10_000_000, False, "0-10M"), (20_000_000, False, "10-20M"),
                (30_000_000, False, "20-30M"), (40_000_000, False, "30-40M")]
INCOME_TOP_BAND = "40M+"


def frequency_word(n):
    """0 -> absent, <=2 occasional, <=5 medium, else very frequent (Spanish labels are data)."""
    return (F.when(n == 0, "rango ausente").when(n <= 2, "ocasional")
            .when(n <= 5, "frecuencia media").otherwise("muy frecuente"))


def income_band_histogram(monthly: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """Per entity, count of months per fixed income band (all five bands present, empty
    ones 0), the frequency word, the entity median income and the band holding it."""
    labels = [b[2] for b in INCOME_BANDS] + [INCOME_TOP_BAND]
    lab = band("income", INCOME_BANDS, INCOME_TOP_BAND)
    counts = monthly.where(F.col("income").isNotNull()).groupBy(id_col).agg(
        *[F.count_if(lab == F.lit(b)).alias(f"_c{i}") for i, b in enumerate(labels)],
        F.median("income").alias("median_income"))
    stacked = counts.select(
        id_col, "median_income",
        F.explode(F.array(*[F.struct(F.lit(i).alias("band_no"), F.lit(b).alias("band"),
                                     F.col(f"_c{i}").alias("months"))
                            for i, b in enumerate(labels)])).alias("s"))
    return stacked.select(
        id_col, F.col("s.band_no").alias("band_no"), F.col("s.band").alias("band"),
        F.col("s.months").alias("months"), frequency_word(F.col("s.months")).alias("frequency"),
        "median_income", band("median_income", INCOME_BANDS, INCOME_TOP_BAND).alias("median_band"))


def saving_profile(monthly: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """Saving variability ('estable' when std < 0.25*mean, else 'variable'), saving-ratio
    mean / median / max and total essential share of income (%)."""
    ratio = F.col("saving") / (F.col("income") + F.lit(EPS)) * 100
    g = monthly.groupBy(id_col).agg(
        F.avg("saving").alias("saving_mean"), F.median("saving").alias("saving_median"),
        F.stddev_samp("saving").alias("saving_std"),
        exact_mean(ratio).alias("ratio_mean"), F.median(ratio).alias("ratio_median"),
        F.max(ratio).alias("ratio_max"),
        (F.sum("essential_spend") / (F.sum("income") + F.lit(EPS)) * 100).alias("essential_pct"))
    trend = F.when(F.col("saving_std") < F.col("saving_mean") * 0.25, "estable").otherwise("variable")
    return g.withColumn("variability", trend)
