"""Mixing to target weights with soft domain membership, with DataFrame operations only.

A naive Bayes classifier over the hashed words of the whole text, its share of distinct words
and its length is counted from the labelled table and predicts each document's posterior over the domains. How far a text's words may be
trusted is fitted as well: every labelled text is scored with the counts of the half it is
not in, and the scale and the power of the length that suit the labels best are taken.
Nonnegative rates w, one per document, then meet the targets in the sense of least squares, by
projected gradient from w = 1. Distances are weighed by the inverse of the domain-by-domain sums
of tokens * posterior * posterior, so close domains are no slower than distinct ones. Each round
is one aggregation over the narrow table: every rate moves against its gradient, which is the
sum over domains of posterior * weighed distance, and is cut at 0; the next round's length comes
from the curvature met (spectral steps). A round that ends above the last ``LOOK_BACK`` ones goes
only the best part of its way.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement, count

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables

BUCKETS = 1 << 16       # of word hashes: bounds the table of counts
BINS = 12              # of the share of distinct words and of the length
SCALES = [(2.0 ** k, power) for power in (0.0, 0.5, 1.0) for k in range(-6, 11)]   # score: scale * sum / length^power
CLOSE = 1e-9            # distance to the targets, relative to the supply, or move of the rates, at which the rounds end
LOOK_BACK = 10          # rounds: distances may grow within them, not beyond
WRITTEN = 8             # rounds after which the rates are written out and the plan starts anew


def with_words(docs: DataFrame) -> DataFrame:
    """doc_id, mix_row (tells rows apart), mix_u (a uniform hash of the row), mix_half (0 or
    1, by the same hash), mix_tokens (words between ASCII blanks), mix_bins (share of distinct
    words and length) and mix_w, the buckets of all words in order."""
    rest = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("mix_t"))
    rest = rest.withColumn("mix_w", F.split(F.trim(F.translate("mix_t", "\t\n\x0b\x0c\r", "     ")), " +"))
    some = F.col("mix_w")[0] != ""
    share = F.least(F.lit(BINS - 1), F.floor(F.size(F.array_distinct("mix_w")) * F.lit(float(BINS)) / F.size("mix_w")))
    length = F.least(F.lit(BINS - 1), F.floor(F.log2(F.octet_length("mix_t") + 1) / 2))
    h = F.xxhash64("doc_id", "mix_t")
    return rest.select("doc_id", F.monotonically_increasing_id().alias("mix_row"),
                       (F.pmod(h, F.lit(1 << 30)) / float(1 << 30)).alias("mix_u"),
                       F.pmod(F.shiftrightunsigned(h, 40), F.lit(2)).cast("int").alias("mix_half"),
                       F.when(some, F.size("mix_w")).otherwise(0).cast("long").alias("mix_tokens"),
                       F.array(share.cast("int"), length.cast("int")).alias("mix_bins"),
                       F.when(some, F.transform("mix_w", lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")))
                       .otherwise(F.array().cast("array<int>")).alias("mix_w"))


def _log(count: Column, total: float) -> Column:
    return F.log((count + 0.5) / (total + 0.5 * BUCKETS))


def _sums(rows: DataFrame, table: DataFrame, logs: list[Column], keys: list[str]) -> DataFrame:
    """Per row of ``rows``: ``keys``, the sum of ``logs`` over its words in ``table`` (s) and
    their number (n). Words that no labelled text has say nothing."""
    hit = (rows.select(*keys, F.explode_outer("mix_w").alias("b"))
           .join(F.broadcast(table), "b", "left").select(*keys, *(v.alias(f"l{d}") for d, v in enumerate(logs))))
    hit = hit.groupBy(*keys).agg(F.count("l0").alias("n"), *(F.sum(f"l{d}").alias(f"l{d}") for d in range(len(logs))))
    return hit.select(*keys, "n", F.array(*(F.coalesce(f"l{d}", F.lit(0.0)) for d in range(len(logs)))).alias("s"))


def _base(priors: list[float], shapes: list[list[list[float]]]) -> Column:
    """Log prior of each domain plus the log probabilities of mix_bins."""
    held = lambda logs, j: F.element_at(F.array(*map(F.lit, logs)), F.col("mix_bins")[j] + 1)
    return F.array(*(sum((held(logs, j) for j, logs in enumerate(shape)), F.lit(p)) for p, shape in zip(priors, shapes)))


def _scores(scale: Column, power: Column) -> Column:
    """Score of each domain from base, s and n."""
    at = scale / F.pow(F.greatest("n", F.lit(1)), power)
    return F.zip_with("base", "s", lambda b, x: b + at * x)


def with_posteriors(docs: DataFrame, labels: DataFrame, domain: str, domains: list) -> DataFrame:
    """One row per row of ``docs``: doc_id, mix_u, mix_tokens and mix_p, the array of
    posteriors over the domains. The driver holds a few numbers per domain only."""
    rows = tables.scratch(with_words(docs), "words")
    # written, so that its size is known before the join is planned: few labels are sent to the words
    known = tables.scratch(labels.filter(F.col(domain).isin(*domains)).groupBy("doc_id").agg(F.max(domain).alias("mix_d")), "known")
    index = F.coalesce(*(F.when(F.col("mix_d") == d, F.lit(i)) for i, d in enumerate(domains)))
    taught = tables.scratch(rows.join(known, "doc_id").select("mix_row", "mix_half", "mix_bins", "mix_w", index.alias("d")), "taught")
    cells = [(d, half) for d in range(len(domains)) for half in (0, 1)]
    name = lambda d, half: f"c{d}_{half}"
    # by bucket: words of each domain and half
    table = tables.scratch(taught.select("d", "mix_half", F.explode("mix_w").alias("b")).groupBy("b").agg(*(
        F.count(F.when((F.col("d") == d) & (F.col("mix_half") == half), 1)).alias(name(d, half)) for d, half in cells)), "buckets")
    total = dict(zip(cells, (v or 0 for v in table.agg(*(F.sum(name(*c)) for c in cells)).first())))
    bins = {(r.d, r.j, r.b): r.n for r in taught.select("d", F.posexplode("mix_bins").alias("j", "b"))
            .groupBy("d", "j", "b").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = [sum(n for (k, j, _), n in bins.items() if (k, j) == (d, 0)) for d in range(len(domains))]
    priors = [math.log(n + 1.0) for n in size]
    shapes = [[[math.log((bins.get((d, j, b), 0) + 0.5) / (n + 0.5 * BINS)) for b in range(BINS)] for j in range(2)]
              for d, n in enumerate(size)]

    def unseen(d: int, half: int) -> Column:
        """From the other half; null where no text of that half has the word."""
        there = [F.col(name(e, 1 - half)) for e in range(len(domains))]
        return F.when(sum(there[1:], there[0]) > 0, _log(there[d], total[d, 1 - half]))

    other = [F.when(F.col("mix_half") == 0, unseen(d, 0)).otherwise(unseen(d, 1)) for d in range(len(domains))]
    base = _base(priors, shapes).alias("base")
    tried = tables.scratch(_sums(taught, table, other, ["mix_row", "mix_half", "mix_bins", "d"])
                           .select("n", "s", "d", base), "tried")
    scales = F.expr("array(" + ", ".join(f"struct({a}D AS scale, {b}D AS power)" for a, b in SCALES) + ")")
    z = (tried.withColumn("by", F.explode(scales)).select("by", "d", _scores(F.col("by.scale"), F.col("by.power")).alias("z"))
         .withColumn("m", F.array_max("z")))
    loss = F.col("m") + F.log(F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("m")))) - F.element_at("z", F.col("d") + 1)
    best = min(((r.loss, *r.by) for r in z.groupBy("by").agg(F.sum(loss).alias("loss")).collect()), default=(0.0, *SCALES[0]))

    logs = [_log(F.col(name(d, 0)) + F.col(name(d, 1)), total[d, 0] + total[d, 1]) for d in range(len(domains))]
    scored = _sums(rows, table, logs, ["mix_row", "doc_id", "mix_u", "mix_tokens", "mix_bins"])
    scored = scored.select("doc_id", "mix_u", "mix_tokens", "n", "s", base)
    scored = scored.withColumn("z", _scores(F.lit(best[1]), F.lit(best[2])))
    scored = scored.withColumn("e", F.expr("transform(z, x -> exp(x - array_max(z)))"))
    return scored.select("doc_id", "mix_u", "mix_tokens", F.expr("transform(e, x -> x / aggregate(e, 0D, (a, y) -> a + y))").alias("mix_p"))


def fit_targets(supply: list[float], weights: list[float], budget: float | None) -> list[float]:
    """Target tokens per domain. A stated ``budget`` is dealt out by the weights. Without one
    the total is the largest at which the wanted domains (those of the largest weight that
    have supply) are used up; the others get their weight of it, or their supply where that
    is less: a scarce domain shrinks no other."""
    share = [w / sum(weights) for w in weights]
    if budget is not None:
        return [budget * w for w in share]
    top = max((w for s, w in zip(supply, share) if s > 0), default=0.0)
    total = max((s / w for s, w in zip(supply, share) if w == top and w > 0), default=0.0)
    return [min(s, total * w) for s, w in zip(supply, share)]


def fit_rates(rows: DataFrame, weights: list[float], budget: float | None) -> tuple[DataFrame, list[float], float]:
    """(``rows`` with mix_tokens and mix_p and their rate, target tokens per domain by
    ``fit_targets``, largest relative distance left between a target and what is expected).
    Rounds go on until all distances are ``CLOSE`` to zero or the rates no longer move, so a
    distance that is left means that no nonnegative rates meet the targets."""
    n = len(weights)
    p, t, rate, to = F.col("mix_p"), F.col("mix_tokens"), F.col("rate"), F.col("mix_to")
    pairs = list(combinations_with_replacement(range(n), 2))
    row = rows.agg(*(F.sum(t * p[d]) for d in range(n)), *(F.sum(t * p[a] * p[b]) for a, b in pairs)).first()
    row = [v or 0.0 for v in row]
    supply, gram = np.array(row[:n], float), np.zeros((n, n))
    for (a, b), v in zip(pairs, row[n:]):
        gram[a, b] = gram[b, a] = v
    weigh = np.linalg.pinv(gram, rcond=CLOSE, hermitian=True)
    target = fit_targets(supply.tolist(), weights, budget)
    unit = np.where(supply > 0, supply, 1.0)
    wanted = np.where(supply > 0, target, 0.0)
    fitted, now, length, costs = rows.withColumn("rate", F.lit(1.0)), supply, 1.0, []
    for done in count(1):
        miss = now - wanted
        if np.abs(miss / unit).max(initial=0.0) <= CLOSE:
            break
        costs = [*costs, miss @ weigh @ miss][-LOOK_BACK:]
        force = weigh @ miss
        move = sum((p[d] * float(length * f) for d, f in enumerate(force)), F.lit(0.0))
        moved = fitted.withColumn("mix_to", F.greatest(F.lit(0.0), rate - move))
        # expected tokens after the whole move, and its squared length
        row = moved.agg(*(F.sum(t * to * p[d]) for d in range(n)), F.sum(t * (to - rate) * (to - rate))).first()
        way, square = np.array(row[:n], float) - now, row[n]
        curve, slope = float(way @ weigh @ way), float(force @ way)
        if square <= CLOSE ** 2 * supply.sum() or slope >= 0 or curve <= 0:
            break
        whole = (miss + way) @ weigh @ (miss + way) <= max(costs)
        part = 1.0 if whole else min(1.0, -slope / curve)
        fitted = moved.withColumn("rate", to if part == 1.0 else rate + part * (to - rate)).drop("mix_to")
        now, length = now + part * way, max(1.0, square / curve)
        if done % WRITTEN == 0:
            fitted = tables.scratch(fitted, "rates")
    gap = [abs(a - b) / (b if b > 0 else c) for a, b, c in zip(now.tolist(), target, unit.tolist())]
    return fitted, target, max(gap, default=0.0)


def mix(docs: DataFrame, labels: DataFrame, domain: str, weights: dict, budget: float | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, tokens, p (posterior per domain, in the order of
    ``weights``), rate, copies: the whole part of the rate, plus one with the fractional
    part as probability (by a hash of id and text, so repeated rows agree), and gap, the
    largest relative distance of a domain's expected tokens to its target (the same in every
    row): more than rounding only where no rates meet the targets.

    ``labels`` holds doc_id and ``domain``; rows with other or null labels are left out of
    the fit, and without labels all posteriors are equal. Null and empty texts have 0
    tokens and do not move the fit. ``budget`` is the total of the targets; without one no
    token of a wanted domain is dropped (``fit_targets``). A domain with no or too little
    supply keeps what it has and the others are not shrunk to it. Other columns are ignored; an empty table gives an empty result.
    """
    rows = tables.scratch(with_posteriors(docs, labels, domain, list(weights)), "posteriors")
    out, _, gap = fit_rates(rows, list(weights.values()), budget)
    return out.select("doc_id", F.col("mix_tokens").alias("tokens"), F.col("mix_p").alias("p"), "rate", _copies().alias("copies"),
                      F.lit(gap).alias("gap"))


def _copies() -> Column:
    return (F.floor("rate") + (F.col("mix_u") < F.col("rate") - F.floor("rate")).cast("int")).cast("int")


def mixed_documents(docs: DataFrame, labels: DataFrame, domain: str, weights: dict) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them, with their own columns. Rows
    whose doc_id is null and rows of 0 tokens stay once; different texts of one doc_id are
    taken as often as the one that is taken most."""
    often = F.max(F.when(F.col("tokens") > 0, F.col("copies")).otherwise(1)).alias("mix_copies")
    other = tables.scratch(mix(docs, labels, domain, weights).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(often)
                           .filter("mix_copies <> 1"), "copies")
    taken = docs.join(other, "doc_id", "left").filter("mix_copies IS NULL OR mix_copies > 0")
    return taken.withColumn("mix_copy", F.explode(F.expr("sequence(1, coalesce(mix_copies, 1))"))).select(*docs.columns)


# Domains are the quality labels; the low one is kept at a tenth of the tokens.
WEIGHTS = {1: 0.9, 0: 0.1}


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    mixed = mix(docs, tables.read(spark, sf_dir, "labels"), "quality", WEIGHTS)
    return mixed.select("doc_id", "tokens", F.col("p")[0].alias("p_high"), F.col("p")[1].alias("p_low"), "rate", "copies", "gap")
