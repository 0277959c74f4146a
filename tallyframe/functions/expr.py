"""Column-level building blocks (all Catalyst built-ins, no Python UDFs).

Each helper returns a ``Column`` so callers compose them inside one projection and
whole-stage codegen keeps them in a single fused stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: ColLike, den: ColLike) -> Column:
    """``num / den`` with NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(col(num), col(den))


def clip(x: ColLike, lo: float, hi: float) -> Column:
    """Clip to ``[lo, hi]``; NULL stays NULL (``greatest``/``least`` would skip it)."""
    x = col(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def band(x: ColLike, bounds: Sequence[tuple[float, bool, str]], otherwise: str | None) -> Column:
    """Ordered CASE banding.

    ``bounds`` is a list of ``(bound, inclusive, label)`` checked in order: a row gets
    ``label`` when ``x <= bound`` (inclusive) or ``x < bound`` (exclusive). Rows above
    every bound get ``otherwise``; NULL input gives NULL.
    """
    x = col(x)
    expr = None
    for bound, inclusive, label in bounds:
        cond = x <= F.lit(bound) if inclusive else x < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(otherwise))
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(expr)


def band_desc(x: ColLike, bounds: Sequence[tuple[float, bool, str]], otherwise: str | None) -> Column:
    """Like :func:`band` but tests ``x >= bound`` / ``x > bound`` from the top down."""
    x = col(x)
    expr = None
    for bound, inclusive, label in bounds:
        cond = x >= F.lit(bound) if inclusive else x > F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(otherwise))
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(expr)


def clean_amount(s: ColLike) -> Column:
    """Lenient money cleaning: keep only ``[0-9.-]``; empty or unparseable -> 0.

    ``'1.234.567'`` keeps two dots, does not parse and so becomes 0 (not NULL).
    """
    kept = F.regexp_replace(col(s).cast("string"), r"[^0-9.\-]", "")
    # cast only well-formed numbers: a failed cast costs an exception per row
    ok = kept.rlike(r"^-?(\d+\.?\d*|\.\d+)$")
    return F.when(ok, kept.try_cast("double")).otherwise(F.lit(0.0))


def safe_double(s: ColLike) -> Column:
    """``try_cast(s AS DOUBLE)`` without the exception cost on text that cannot be a
    number: only strings made of number characters (or spelling inf / nan) are cast,
    everything else is NULL directly. Same result as ``try_cast``."""
    t = col(s).cast("string")
    maybe = t.rlike(r"^[\s+\-0-9.eEdDfF]*$") | t.rlike(r"(?i)inf|nan")
    return F.when(maybe, t.try_cast("double"))


def strict_amount(s: ColLike) -> Column:
    """Strict variant: strip thousands commas only; anything else unparseable -> NULL."""
    return safe_double(F.regexp_replace(F.trim(col(s).cast("string")), ",", ""))


# Spanish month abbreviations that differ from English, and their English form.
SPANISH_MONTHS = {"ENE": "JAN", "ABR": "APR", "AGO": "AUG", "DIC": "DEC"}

# Text shapes (upper-cased, any run of spaces) and the format each one is parsed with.
DATE_SHAPES = (
    (r"^\d{4}\s+[A-Z]{3}\s+\d{1,2}$", "yyyy MMM d"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}\s+[A-Z]{3}\s+\d{4}$", "d MMM yyyy"),
    (r"^[A-Z]{3}\s+\d{1,2}\s+\d{4}$", "MMM d yyyy"),
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\d{8}$", "yyyyMMdd"),
)


def parse_bilingual_date(s: ColLike) -> Column:
    """``'2025 Ene 05'``, ``'2025 JAN 05'``, ISO and a few common forms -> TIMESTAMP.

    The upper-cased text's shape picks the one format to parse with (no trial-and-error
    parsing); only in that branch are Spanish month abbreviations turned into English
    and spaces normalised. Blank, unrecognised or impossible dates -> NULL.
    """
    u = F.upper(F.trim(col(s).cast("string")))
    expr = None
    for shape, fmt in DATE_SHAPES:
        t = u
        if "MMM" in fmt:
            for es, en in SPANISH_MONTHS.items():
                t = F.regexp_replace(t, es, en)
            t = F.regexp_replace(t, r"\s+", " ")
        if "HH" in fmt:
            t = F.regexp_replace(t, "T", " ")
        parsed = F.try_to_timestamp(t, F.lit(fmt))
        expr = F.when(u.rlike(shape), parsed) if expr is None else expr.when(u.rlike(shape), parsed)
    return expr


def triangular(x: ColLike, a: float, b: float, c: float) -> Column:
    """Triangular membership with shoulders (``a == b`` or ``b == c``); 0 outside [a, c]."""
    x = col(x).cast("double")
    expr = F.when(x == F.lit(float(b)), F.lit(1.0))
    if a != b:
        expr = expr.when((x > F.lit(float(a))) & (x < F.lit(float(b))), (x - F.lit(float(a))) / F.lit(float(b - a)))
    if b != c:
        expr = expr.when((x > F.lit(float(b))) & (x < F.lit(float(c))), (F.lit(float(c)) - x) / F.lit(float(c - b)))
    return expr.otherwise(F.lit(0.0))


def triangular_sql(x: str, a: float, b: float, c: float) -> str:
    """The same membership as an ANSI SQL expression (used by oracle SQL)."""
    parts = [f"WHEN {x} = {float(b)} THEN 1.0"]
    if a != b:
        parts.append(f"WHEN {x} > {float(a)} AND {x} < {float(b)} THEN ({x} - {float(a)}) / {float(b - a)}")
    if b != c:
        parts.append(f"WHEN {x} > {float(b)} AND {x} < {float(c)} THEN ({float(c)} - {x}) / {float(c - b)}")
    return "(CASE " + " ".join(parts) + " ELSE 0.0 END)"


def capitalize(s: ColLike) -> Column:
    """First character upper, the rest lower (not ``initcap``, which does every word)."""
    s = col(s)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def normalize_ws(s: ColLike) -> Column:
    return F.trim(F.regexp_replace(col(s), r"\s+", " "))


def money(x: ColLike, decimals: int = 2) -> Column:
    """``$1,234.50`` style text."""
    return F.concat(F.lit("$"), F.format_number(col(x), decimals))


def exact_mean(x: ColLike, scale: int = 6) -> Column:
    """Mean from an exact DECIMAL sum: identical on every engine and partitioning, even
    when values span many magnitudes (floating sums depend on the order of addition)."""
    x = col(x)
    return F.sum(x.cast(f"decimal(38,{scale})")).cast("double") / F.count(x)
