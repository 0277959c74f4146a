"""Rule-based financial recommendation scored per entity.

movements -> ``monthly_cash_flow`` -> ``trailing_metrics`` -> fuzzy score (one
projection) -> optional per-entity neural score (``applyInPandas`` over <= months/15
block rows per entity) -> blend, category, advice, explanation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import band, clip
from ..functions.fuzzy import fuzzy_score
from .calendar import monthly_cash_flow
from .cashflow import block_features, trailing_metrics

FUZZY_WEIGHT = 0.6
NEURAL_WEIGHT = 0.4

# Score bands (upper bound inclusive) with category and advice text.
CATEGORIES = [
    (30, "EMERGENCIA", "Recortar gastos no esenciales, crear fondo de emergencia, revisar deudas."),
    (60, "CONSERVADOR", "Mantener ahorro, instrumentos de bajo riesgo, construir fondo 3-6 meses."),
    (80, "MODERADO", "Incrementar inversiones, considerar riesgo medio, plan largo plazo."),
]
TOP_CATEGORY = ("AGRESIVO", "Diversificar agresivamente, aprovechar alta capacidad de ahorro.")

# Which component explains the score.
AGREE_TOLERANCE = 3
EXPLAIN_AGREE = "Ambos módulos coinciden: las reglas difusas y la red neuronal ven un perfil similar."
EXPLAIN_FUZZY = ("El componente difuso domina porque las métricas actuales encajan mejor con las reglas "
                 "de ahorro, gasto esencial y estabilidad predefinidas.")
EXPLAIN_NEURAL = ("El componente neuronal domina al detectar patrones recientes que sugieren "
                  "un comportamiento distinto al esperado por las reglas difusas.")


def with_fuzzy(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn(
        "fuzzy_score", fuzzy_score("saving_ratio", "essential_ratio", "stability"))


def blend(scored: DataFrame, neural_col: str = "neural_score") -> DataFrame:
    """0.6 * fuzzy + 0.4 * neural, clipped, banded, with advice and explanation.

    With no neural model the neural part is the saving ratio. When no rule fires the
    fuzzy score, the blend and the category are NULL.
    """
    neural = F.coalesce(F.col(neural_col), F.col("saving_ratio")) if neural_col in scored.columns \
        else F.col("saving_ratio")
    s = scored.withColumn("neural_score", neural)
    score = clip(F.col("fuzzy_score") * FUZZY_WEIGHT + F.col("neural_score") * NEURAL_WEIGHT, 0, 100)
    s = s.withColumn("score", score)
    cat = band("score", [(b, True, c) for b, c, _ in CATEGORIES], TOP_CATEGORY[0])
    advice = band("score", [(b, True, a) for b, _, a in CATEGORIES], TOP_CATEGORY[1])
    diff = F.col("fuzzy_score") - F.col("neural_score")
    explain = (F.when(F.abs(diff) <= AGREE_TOLERANCE, EXPLAIN_AGREE)
               .when(diff > 0, EXPLAIN_FUZZY).when(diff <= 0, EXPLAIN_NEURAL))
    return s.withColumn("category", cat).withColumn("advice", advice).withColumn("explanation", explain)


def recommend(movements: DataFrame, id_col: str = "entity_id", t_col: str = "t",
              debit: str = "debit", credit: str = "credit", neural: bool = True) -> DataFrame:
    """End-to-end recommendation per entity from raw movements."""
    from ..session import cut_lineage
    # month-end rows (entities x months spanned) feed both the metrics and the network
    # blocks: materialise them once instead of re-reading the movements twice
    monthly = monthly_cash_flow(movements, id_col, t_col, debit, credit)
    if neural:
        monthly = cut_lineage(monthly)
    metrics = with_fuzzy(trailing_metrics(monthly, id_col))
    if neural:
        from .learn import mini_mlp_scores
        blocks = block_features(monthly, id_col)
        nn = mini_mlp_scores(blocks, metrics, id_col)
        metrics = metrics.join(nn, id_col, "left")
    return blend(metrics)
