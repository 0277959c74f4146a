"""Hard negatives through rotated one-bit codes with stored code-vector alignment.

Vectors are integer; all are turned by one random rotation R. For a row v with y = R v:

* its code is the sign s of every coordinate of y, one bit each;
* its alignment is a = <y, s> / D, so y = a s + r with r orthogonal to s, and the length of
  r is stored beside it.

An anchor q with z = R q is cut into ``PLANES`` bit planes (z = low + step * u + e, e known).
Popcounts of code and planes give g' = <s, low + step * u>, and <s, z> lies within
E = sum |e| of it. The score <v, q> = <y, z> = a <s, z> + <r, z>, and as r is orthogonal to
s, Cauchy-Schwarz bounds the rest by |r| * sqrt(|z|^2 - <s, z>^2 / D). So every pair has a
sure interval [lo, hi]; nothing is left to chance. Pairs whose interval cannot reach the
result are passed over, all others are scored in integers.

Two passes over (block of rows) x (block of anchors): the anchors are the stated query set,
1 row in 100, and each pass leaves only the first few rows of every anchor and task.
 1. positives: same label, the k-th greatest lower bound so far is the bar;
 2. negatives: another label and a score inside the window of one of the positives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tables

ROWS = 2048         # rows in a block
ANCHORS = 256       # anchors in a block
PLANES = 7          # bits per coordinate of a rotated anchor
SEED = 11

ROW_BLOCK = "ids binary, labels binary, vectors binary, codes binary, align binary, rest binary"
ANCHOR_BLOCK = "a_ids binary, a_labels binary, a_vectors binary, a_ranges binary"
FOUND = "anchor_id long, at int, row_id long, score long"


def integer_vectors(embeddings: DataFrame, scale: int = 256, anchor_step: int = 100) -> DataFrame:
    """(vec_id, label, v array<long>, anchor) of the rows that take part: floor(scale * x) of every
    component as double. Rows with a null vec_id, label or vector, or with a null or non-finite
    component take no part."""
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                              F.col("embedding").cast("array<double>").alias("x"))
            .filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").filter(finite)
            .select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v"),
                    (F.col("vec_id") % anchor_step == 0).alias("anchor")))


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _padded(col: pa.Array, dim: int) -> np.ndarray:
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy().astype(np.float64)
    out = np.zeros((len(col), dim))
    row = np.repeat(np.arange(len(col)), size)
    out[row, np.arange(len(flat)) - (np.cumsum(size) - size)[row]] = flat
    return out


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes as uint64 words, alignments, lengths of the rests) of integer vectors."""
    dim = vectors.shape[1]
    y = vectors @ turn.T
    bits = y >= 0
    align = np.abs(y).sum(1) / dim
    rest = np.sqrt(np.maximum((y * y).sum(1) - align * align * dim, 0))
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), align, rest


def intervals(codes: np.ndarray, align: np.ndarray, rest: np.ndarray, z: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """(lo, hi) of the inner product of every anchor (rows of z, rotated) with every row."""
    dim = z.shape[1]
    low = z.min(1)
    step = np.maximum((z.max(1) - low) / (2**PLANES - 1), 1e-12)
    u = np.rint((z - low[:, None]) / step[:, None])
    err = np.abs(z - low[:, None] - step[:, None] * u).sum(1)
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
    plus = np.zeros((len(z), len(codes)), np.int64)     # sum of u over the set bits of a code
    for b in range(PLANES):
        plane = np.packbits((u.astype(np.int64) >> b) & 1, axis=1, bitorder="little").view(np.uint64)
        held = np.zeros(plus.shape, np.int64)
        for w in range(codes.shape[1]):
            held += np.bitwise_count(codes[None, :, w] & plane[:, w, None])
        plus += held << b
    g = low[:, None] * (2 * ones - dim) + step[:, None] * (2 * plus - u.sum(1)[:, None])
    far = np.maximum(np.abs(g) - err[:, None], 0)
    length = (z * z).sum(1)
    across = np.sqrt(np.maximum(length[:, None] - far * far / dim, 0))
    size = np.sqrt(rest * rest + align * align * dim)
    slack = 1e-9 * size * np.sqrt(length)[:, None] + 1e-6      # rounding of the rotation and the sums
    half = align * err[:, None] + rest * across + slack
    middle = align * g
    return middle - half, middle + half


def _row_blocks(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                v = _padded(part.column("v"), dim)
                codes, align, rest = encode(v, turn)
                cells = (part.column("vec_id").to_numpy(), part.column("label").to_numpy(), v.astype(np.int64),
                         codes, align, rest)
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells],
                                                 ["ids", "labels", "vectors", "codes", "align", "rest"])
    return run


def _anchor_blocks(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ANCHORS):
                part = batch.slice(a, ANCHORS)
                cells = [part.column("vec_id").to_numpy(), part.column("label").to_numpy(),
                         _padded(part.column("v"), dim).astype(np.int64)]
                if "ranges" in part.schema.names:       # as many numbers for every anchor
                    cells.append(part.column("ranges").flatten().to_numpy())
                else:
                    cells.append(np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells],
                                                 ["a_ids", "a_labels", "a_vectors", "a_ranges"])
    return run


class _Best:
    """The first ``k`` rows (score falling, then id) of every (anchor, place) that a task met."""

    def __init__(self, k: int):
        self.k = k
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def bar(self, key: tuple[int, int]) -> float:
        """Score that a further row has to reach."""
        held = self.found.get(key)
        return held[0][-1] if held is not None and len(held[0]) == self.k else -np.inf

    def add(self, key: tuple[int, int], score: np.ndarray, ids: np.ndarray) -> None:
        if key in self.found:
            score = np.concatenate([self.found[key][0], score])
            ids = np.concatenate([self.found[key][1], ids])
        first = np.lexsort((ids, -score))[:self.k]
        if len(first):
            self.found[key] = score[first], ids[first]

    def batch(self) -> pa.RecordBatch:
        keys = [key for key, (s, _) in self.found.items() for _ in s]
        flat = [np.concatenate([x[i] for x in self.found.values()]) if self.found else np.zeros(0, np.int64) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in keys], pa.int64()), pa.array([j for _, j in keys], pa.int32()),
             pa.array(flat[1].astype(np.int64)), pa.array(flat[0].astype(np.int64))],
            ["anchor_id", "at", "row_id", "score"])


def _kth(bound: np.ndarray, k: int) -> np.ndarray:
    """k-th greatest of every row; minus infinity where there are fewer."""
    if bound.shape[1] < k:
        return np.full(len(bound), -np.inf)
    return np.partition(bound, bound.shape[1] - k, axis=1)[:, bound.shape[1] - k]


def _search(dim: int, k: int, windows: bool):
    """Pairs of blocks -> the first k rows of every anchor (same label), or of each of its score
    windows (other labels)."""
    def numbers(cell: pa.Scalar, kind=np.int64) -> np.ndarray:
        return np.frombuffer(cell.as_buffer(), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, best = rotation(dim), _Best(k)
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n] for name in batch.schema.names}
                ids, labels = numbers(row["ids"]), numbers(row["labels"])
                vectors = numbers(row["vectors"]).reshape(-1, dim)
                codes = numbers(row["codes"], np.uint64).reshape(len(ids), -1)
                a_ids, a_labels = numbers(row["a_ids"]), numbers(row["a_labels"])
                anchors = numbers(row["a_vectors"]).reshape(-1, dim)
                ranges = numbers(row["a_ranges"]).reshape(len(a_ids), -1, 2)
                lo, hi = intervals(codes, numbers(row["align"], float), numbers(row["rest"], float), anchors @ turn.T)
                same = a_labels[:, None] == labels
                if windows:
                    _near(best, k, a_ids, anchors, ranges, ids, vectors, lo, hi, ~same)
                else:
                    same &= a_ids[:, None] != ids
                    bar = _kth(np.where(same, lo, -np.inf), k)
                    for i, a in enumerate(a_ids.tolist()):
                        at = np.flatnonzero(same[i] & (hi[i] >= max(bar[i], best.bar((a, 0)))))
                        best.add((a, 0), vectors[at] @ anchors[i], ids[at])
        yield best.batch()
    return run


def _near(best, k, a_ids, anchors, ranges, ids, vectors, lo, hi, other) -> None:
    for j in range(ranges.shape[1]):
        least, most = ranges[:, j, :1], ranges[:, j, 1:]
        sure = other & (lo >= least) & (hi <= most)
        bar = np.maximum(_kth(np.where(sure, lo, -np.inf), k), least[:, 0])
        may = other & (lo <= most)
        for i, a in enumerate(a_ids.tolist()):
            if least[i, 0] > most[i, 0]:
                continue
            at = np.flatnonzero(may[i] & (hi[i] >= max(bar[i], best.bar((a, j)))))
            score = vectors[at] @ anchors[i]
            inside = (score >= least[i, 0]) & (score <= most[i, 0])
            best.add((a, j), score[inside], ids[at[inside]])


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "at").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives of ``vectors`` (vec_id, label, v array<long>, anchor boolean).

    One row per negative: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score. An anchor's positives are its first ``positives`` other rows of the same
    label; each positive gets the first ``negatives`` rows of other labels whose score is at
    least ``low`` % and at most ``high`` % of the positive's. First means score falling, ties
    by smaller id. Vectors of unequal length count as ending in zeros. Components must stay
    below 2^24 or so for scores to fit 64 bits. Rows that repeat a vec_id each count as a
    candidate, but never for an anchor of their own id; of anchors that repeat a vec_id the
    least (label, vector) is used. Fewer rows than asked give fewer results, no partner gives
    none; other columns are ignored; an empty table gives an empty result.
    """
    vectors = tables.scratch(vectors.select("vec_id", "label", "v", "anchor"), "vectors")
    dim = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    dim = max(64, -(-dim // 64) * 64)
    rows = tables.scratch(vectors.mapInArrow(_row_blocks(dim), ROW_BLOCK), "rows")
    anchors = tables.scratch(
        vectors.filter("anchor").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("m"))
        .select("vec_id", "m.label", "m.v"), "anchors")

    asked = anchors.mapInArrow(_anchor_blocks(dim), ANCHOR_BLOCK)
    # every block of anchors meets every block of rows: the stated queries against all rows
    near = rows.crossJoin(asked).mapInArrow(_search(dim, positives, False), FOUND)
    first = tables.scratch(_first(near, positives).select(
        "anchor_id", (F.col("rank") - 1).alias("at"), F.col("row_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")

    # the window's ends in integers: low % rounded up, high % rounded down
    window = F.array(F.expr(f"-((-positive_score * {low}) div 100) + "
                            f"CASE WHEN (-positive_score * {low}) % 100 < 0 THEN 1 ELSE 0 END"),
                     F.expr(f"(positive_score * {high}) div 100 - "
                            f"CASE WHEN (positive_score * {high}) % 100 < 0 THEN 1 ELSE 0 END"))
    ranges = (first.groupBy(F.col("anchor_id").alias("vec_id"))
              .agg(F.sort_array(F.collect_list(F.struct("at", window.alias("w")))).alias("ws"))
              .select("vec_id", F.flatten("ws.w").alias("ws")))
    none = F.array(F.lit(1), F.lit(0)).cast("array<bigint>")     # an empty window
    padded = F.flatten(F.array(F.col("ws"), *[none] * positives))
    windowed = anchors.join(ranges, "vec_id").select(
        "vec_id", "label", "v", F.slice(padded, 1, 2 * positives).alias("ranges"))
    far = rows.crossJoin(windowed.mapInArrow(_anchor_blocks(dim), ANCHOR_BLOCK)).mapInArrow(
        _search(dim, negatives, True), FOUND)
    return (_first(far, negatives).join(first, ["anchor_id", "at"])
            .select("anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the whole table ``embeddings``: anchors are the rows whose vec_id is
    divisible by 100; where it is divisible by 7 the label first becomes (label + 1) % 10. Nulls,
    ties and repeated rows as in ``integer_vectors`` and ``hard_negatives``."""
    rows = integer_vectors(tables.read(spark, sf_dir, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label))


OP11_SQL = """
WITH rows AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.row_id) AS INTEGER) AS rank,
       s.row_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
