"""Mamdani fuzzy inference as column expressions.

Memberships, rule strengths (AND = min, per-term OR = max), clipping and the
centroid over the 0..100 output universe are all one projection: the centroid is an
``aggregate`` over the universe points (plus the activation cut points) evaluated per
row, so there is no shuffle, no explode and no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import ColLike, col, triangular, triangular_sql

# Triangular terms (a, b, c) on the 0..100 universe, per input and output.
SAVING_TERMS = {"low": (0, 0, 20), "medium": (10, 30, 50), "high": (40, 100, 100)}
ESSENTIAL_TERMS = {"low": (0, 0, 35), "medium": (25, 45, 65), "high": (55, 100, 100)}
STABILITY_TERMS = {"low": (0, 0, 50), "medium": (30, 60, 90), "high": (70, 100, 100)}
OUTPUT_TERMS = {"emergency": (0, 0, 30), "conservative": (20, 40, 60),
                "moderate": (50, 65, 80), "aggressive": (70, 100, 100)}

# The six rules, antecedents joined by AND, in the order they are declared.
RULES = [
    ({"saving": "low", "essential": "high"}, "emergency"),
    ({"saving": "low", "essential": "medium"}, "conservative"),
    ({"saving": "medium", "stability": "high"}, "moderate"),
    ({"saving": "high", "stability": "high", "essential": "low"}, "aggressive"),
    ({"saving": "medium", "stability": "low"}, "conservative"),
    ({"saving": "high", "stability": "medium"}, "moderate"),
]

INPUT_TERMS = {"saving": SAVING_TERMS, "essential": ESSENTIAL_TERMS, "stability": STABILITY_TERMS}
UNIVERSE_MAX = 100


def _greatest(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def _least(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.least(*cols)


def term_activations(saving: ColLike, essential: ColLike, stability: ColLike) -> dict[str, Column]:
    """Output term -> firing strength (max over the rules that conclude it)."""
    inputs = {"saving": col(saving), "essential": col(essential), "stability": col(stability)}
    strength: dict[str, list[Column]] = {t: [] for t in OUTPUT_TERMS}
    for ante, out in RULES:
        mus = [triangular(inputs[v], *INPUT_TERMS[v][term]) for v, term in ante.items()]
        strength[out].append(_least(mus))
    return {t: (_greatest(s) if s else F.lit(0.0)) for t, s in strength.items()}


def _mu(acts: dict[str, Column], x: Column) -> Column:
    """Aggregated output membership at x: max over terms of min(activation, term(x))."""
    return _greatest([F.least(a, triangular(x, *OUTPUT_TERMS[t])) for t, a in acts.items()])


def cut_points(acts: dict[str, Column]) -> Column:
    """x positions where each output term's sides cross its activation level
    (0 < activation < 1): these are where the clipped set changes slope."""
    pts = []
    for t, act in acts.items():
        a, b, c = (float(v) for v in OUTPUT_TERMS[t])
        inside = (act > 0) & (act < 1)
        if a != b:
            pts.append(F.when(inside, F.lit(a) + act * (b - a)))
        if b != c:
            pts.append(F.when(inside, F.lit(c) - act * (c - b)))
    return F.filter(F.array(*pts), lambda v: v.isNotNull())


def centroid(acts: dict[str, Column], refine: bool = True) -> Column:
    """Centroid of the clipped, max-aggregated output set over [0, 100]; NULL when no
    rule fires.

    ``refine=True``: the output universe 0..100 (step 1) plus the activation cut points,
    membership evaluated there and integrated piecewise linearly (trapezoids).
    ``refine=False``: the discrete centroid sum(x mu) / sum(mu) over 0..100.
    """
    if not refine:
        zero = F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den"))
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(UNIVERSE_MAX)), zero,
            lambda acc, x: F.struct((acc["num"] + x.cast("double") * _mu(acts, x.cast("double"))).alias("num"),
                                    (acc["den"] + _mu(acts, x.cast("double"))).alias("den")),
            lambda acc: F.when(acc["den"] > 0, acc["num"] / acc["den"]))
    grid = F.transform(F.sequence(F.lit(0), F.lit(UNIVERSE_MAX)), lambda x: x.cast("double"))
    pts = F.array_sort(F.array_union(grid, cut_points(acts)))
    mus = F.transform(pts, lambda x: _mu(acts, x))
    xy = F.arrays_zip(pts.alias("x"), mus.alias("y"))
    zero = F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den"), F.lit(None).cast("double").alias("px"),
                    F.lit(None).cast("double").alias("py"))

    def step(acc, e):
        x1, y1, x2, y2 = acc["px"], acc["py"], e["x"], e["y"]
        seg = x1.isNotNull() & ((y1 + y2) > 0)
        area = (x2 - x1) * (y1 + y2) / 2
        cx = x1 + (x2 - x1) * (y1 + 2 * y2) / (3 * (y1 + y2))
        return F.struct(F.when(seg, acc["num"] + area * cx).otherwise(acc["num"]).alias("num"),
                        F.when(seg, acc["den"] + area).otherwise(acc["den"]).alias("den"),
                        x2.alias("px"), y2.alias("py"))

    return F.aggregate(xy, zero, step, lambda acc: F.when(acc["den"] > 0, acc["num"] / acc["den"]))


def fuzzy_score(saving: ColLike, essential: ColLike, stability: ColLike, refine: bool = True) -> Column:
    return centroid(term_activations(saving, essential, stability), refine)


# ---- the same inference as DuckDB SQL text, for the oracle --------------------------

def activations_sql(saving: str, essential: str, stability: str) -> dict[str, str]:
    inputs = {"saving": saving, "essential": essential, "stability": stability}
    strength: dict[str, list[str]] = {t: [] for t in OUTPUT_TERMS}
    for ante, out in RULES:
        mus = [triangular_sql(inputs[v], *INPUT_TERMS[v][term]) for v, term in ante.items()]
        strength[out].append(mus[0] if len(mus) == 1 else "least(" + ", ".join(mus) + ")")
    return {t: (s[0] if len(s) == 1 else "greatest(" + ", ".join(s) + ")") for t, s in strength.items()}


def membership_sql(acts: dict[str, str], x: str) -> str:
    parts = [f"least({a}, {triangular_sql(x, *OUTPUT_TERMS[t])})" for t, a in acts.items()]
    return "greatest(" + ", ".join(parts) + ")"


def cut_points_sql(acts: dict[str, str]) -> list[str]:
    out = []
    for t, act in acts.items():
        a, b, c = (float(v) for v in OUTPUT_TERMS[t])
        if a != b:
            out.append(f"CASE WHEN {act} > 0 AND {act} < 1 THEN {a} + {act} * {b - a} END")
        if b != c:
            out.append(f"CASE WHEN {act} > 0 AND {act} < 1 THEN {c} - {act} * {c - b} END")
    return out
