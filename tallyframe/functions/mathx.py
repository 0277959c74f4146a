"""Closed-form math written once as SQL text templates.

The same template feeds Spark (``F.expr``) and DuckDB oracle SQL, so both engines
evaluate the identical formula. ``{x}`` is substituted with a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Acklam's rational approximation to the normal quantile.
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00)
_P_LOW = 0.02425


def _horner(coefs, v: str) -> str:
    s = repr(coefs[0])
    for c in coefs[1:]:
        s = f"({s} * {v} + {c!r})"
    return s


def norm_ppf_sql(x: str) -> str:
    """Standard normal quantile of probability ``x`` (relative error ~1e-9)."""
    ql = f"sqrt(-2 * ln({x}))"
    qh = f"sqrt(-2 * ln(1 - ({x})))"
    r = f"(({x}) - 0.5) * (({x}) - 0.5)"
    tail_lo = f"({_horner(_C, ql)} / ({_horner(_D, ql)} * {ql} + 1))"
    tail_hi = f"(-{_horner(_C, qh)} / ({_horner(_D, qh)} * {qh} + 1))"
    mid = f"({_horner(_A, r)} * (({x}) - 0.5) / ({_horner(_B, r)} * {r} + 1))"
    return (f"(CASE WHEN ({x}) <= 0 OR ({x}) >= 1 THEN NULL WHEN ({x}) < {_P_LOW} THEN {tail_lo} "
            f"WHEN ({x}) <= {1 - _P_LOW} THEN {mid} ELSE {tail_hi} END)")


# Chebyshev-fitted complementary error function coefficients (|rel err| < 1.2e-7).
_ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807,
         -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def norm_cdf_sql(x: str) -> str:
    """Standard normal CDF via erfc(-x / sqrt 2)."""
    z = f"(-({x}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.5 * abs({z})))"
    poly = repr(_ERFC[-1])
    for c in reversed(_ERFC[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    ans = f"({t} * exp(-{z} * {z} + {poly}))"
    erfc = f"(CASE WHEN {z} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"
    return f"(0.5 * {erfc})"


def norm_ppf(x: str) -> Column:
    return F.expr(norm_ppf_sql(x))


def norm_cdf(x: str) -> Column:
    return F.expr(norm_cdf_sql(x))
