"""Calendar aggregation: month-end totals with a gap-filling spine, period group-bys,
future period generation.

Scale notes: every aggregate is a ``groupBy`` with map-side partial aggregation, so a
hot entity costs one partial row per (task, entity, period) before the shuffle. The
calendar spine is built from per-entity month maps whose size is bounded by the
number of months an entity spans (calendar bound), never by its row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import ColLike, col


def month_end_totals(df: DataFrame, id_col: str, t_col: ColLike, sums: dict[str, ColLike],
                     month_col: str = "month_end") -> DataFrame:
    """Per entity, one row per calendar month end from its first to its last dated month.

    ``sums`` maps output name -> value expression; months without rows get 0.
    Rows with a NULL date are dropped (as a month-end resample drops them).
    """
    names = list(sums)
    dated = df.where(col(t_col).isNotNull()).select(
        F.col(id_col), F.last_day(col(t_col)).alias(month_col),
        *[col(e).alias(n) for n, e in sums.items()])
    monthly = dated.groupBy(id_col, month_col).agg(*[F.sum(n).alias(n) for n in names])
    # One row per entity: its month range and a month -> totals map (<= months spanned).
    per_id = monthly.groupBy(id_col).agg(
        F.min(month_col).alias("_lo"), F.max(month_col).alias("_hi"),
        F.map_from_entries(F.collect_list(F.struct(F.col(month_col), F.struct(*names)))).alias("_m"))
    spine = per_id.select(
        id_col, "_m",
        F.explode(F.sequence(F.trunc("_lo", "month"), F.trunc("_hi", "month"),
                             F.expr("INTERVAL 1 MONTH"))).alias("_ms"))
    me = F.last_day("_ms")
    return spine.select(
        F.col(id_col), me.alias(month_col),
        *[F.coalesce(F.element_at("_m", me).getField(n), F.lit(0)).alias(n) for n in names])


def monthly_cash_flow(movements: DataFrame, id_col: str = "entity_id", t_col: str = "t",
                      debit: str = "debit", credit: str = "credit",
                      essential_share: float = 0.6) -> DataFrame:
    """Month-end income / spending / saving per entity.

    Spending is split into essential (``essential_share``) and discretionary parts;
    saving = income - spending. Empty months inside an entity's range are 0.
    """
    m = month_end_totals(movements, id_col, t_col, {"income": credit, "spend": debit})
    share = F.lit(essential_share)
    return m.select(
        id_col, "month_end", F.col("income"),
        (F.col("spend") * share).alias("essential_spend"),
        (F.col("spend") * (F.lit(1) - share)).alias("discretionary_spend"),
        (F.col("income") - F.col("spend")).alias("saving"))


def period_totals(df: DataFrame, keys: list[ColLike], t_col: ColLike, unit: str,
                  aggs: list[Column], period_col: str = "period") -> DataFrame:
    """Plain calendar group-by (``day``/``week``/``month``/``quarter``/``year``); gaps are
    not filled."""
    p = F.to_date(col(t_col)) if unit == "day" else F.to_date(F.date_trunc(unit, col(t_col)))
    return df.where(col(t_col).isNotNull()).groupBy(*[col(k) for k in keys], p.alias(period_col)).agg(*aggs)


def future_months(last: DataFrame, id_col: str, t_col: str, horizon: int,
                  out_col: str = "month_start") -> DataFrame:
    """``horizon`` month starts following each entity's last date (step = 1..h)."""
    return last.select(
        id_col, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), F.col(t_col)
    ).select(id_col, "step", F.add_months(F.trunc(t_col, "month"), F.col("step")).alias(out_col))


def undated_blocks(df: DataFrame, id_col: str, order_col: str, sums: dict[str, ColLike],
                   t_col: ColLike, rows_per_block: int = 30) -> DataFrame:
    """Fallback for entities with no date at all: consecutive blocks of ``rows_per_block``
    rows in ``order_col`` order, summed. Only the rows of such entities are ranked
    (skew-safe positions from ``group_positions``)."""
    from .ranks import group_positions
    dated_ids = df.where(col(t_col).isNotNull()).select(id_col).distinct()
    undated = df.join(dated_ids, id_col, "left_anti")
    p = group_positions(undated, [id_col], order_col, "_pos", "_n")
    blk = F.floor((F.col("_pos") - 1) / rows_per_block).cast("long").alias("block")
    return p.groupBy(id_col, blk).agg(*[F.sum(col(e)).alias(n) for n, e in sums.items()])
