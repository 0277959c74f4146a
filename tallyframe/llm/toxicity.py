"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is its bag of 3-5 byte n-grams (with word ends) hashed into ``BUCKETS`` rows of an
embedding table, so unseen spellings share vectors with known ones. A span of ``SPAN``
words is the average of its words' bags, and a text is the average of all its spans, each
weighted by exp(``SHARP`` * its own toxicity); that one vector goes through a two-class linear
softmax. A plain average would drown a few toxic words in a long text, so training starts from
it and sharpens the weights; a text is scored with the average that training ended with. As the
softmax is linear, the average of the vectors is taken as that of their scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables, words

BUCKETS = 1 << 17
DIM = 12
SPAN = 2
SHARP = 8.0
SAMPLE = 1500       # default of ``train``: labelled training texts per class, at most
STEPS = 110
THRESHOLD = 0.3
BLOCK_BYTES = 3 << 20   # n-grams of a block's distinct words are held at once


@dataclass
class Model:
    weights: np.ndarray  # per bucket: embedding times (toxic - clean) softmax weights
    bias: float


def _subwords(vocab: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram, n-grams per word), grouped by word."""
    marked = np.frombuffer(b"".join(b"<" + w + b">" for w in vocab), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, vocab), np.int64, len(vocab)) + 2
    ends = np.cumsum(size)
    owner = np.repeat(np.arange(len(vocab), dtype=np.int32), size)
    left = ends[owner] - np.arange(len(owner))
    buckets, owners = [], []
    for n in (3, 4, 5):
        acc = np.full(max(0, len(marked) - n + 1), n, np.uint64)
        for j in range(n):
            acc = acc * np.uint64(0x100000001B3) + marked[j:len(marked) - n + 1 + j]
        fits = left[:len(acc)] >= n
        buckets.append((words.mix64(acc[fits]) % np.uint64(BUCKETS)).astype(np.int32))
        owners.append(owner[:len(acc)][fits])
    bucket, own = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return bucket[order], np.bincount(own, minlength=len(vocab))


def _means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of consecutive groups (all groups hold at least one value)."""
    return np.add.reduceat(values, np.cumsum(counts) - counts) / counts


def _spans(scores: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean score of every span, spans per text). Texts with fewer words are one span."""
    made = np.where(counts > 0, np.maximum(counts - SPAN + 1, 1), 0)
    total = np.concatenate([[0.0], np.cumsum(scores)])
    owner = np.repeat(np.arange(len(counts)), made)
    start = np.arange(len(owner)) - (np.cumsum(made) - made)[owner] + (np.cumsum(counts) - counts)[owner]
    stop = np.minimum(start + SPAN, np.cumsum(counts)[owner])
    return (total[stop] - total[start]) / (stop - start), made


def _averages(spans: np.ndarray, made: np.ndarray, sharp: float) -> tuple[np.ndarray, np.ndarray]:
    """(weight of every span within its text, weighted average of each text's spans); every
    text holds at least one."""
    first = np.cumsum(made) - made
    owner = np.repeat(np.arange(len(made)), made)
    weight = np.exp(np.minimum(0, sharp * (spans - np.maximum.reduceat(spans, first)[owner])))
    weight /= np.add.reduceat(weight, first)[owner]
    return weight, np.add.reduceat(weight * spans, first)


def _logits(model: Model, texts: list[bytes] | Iterator[bytes]) -> np.ndarray:
    ids, counts, vocab = words.block_words(texts)
    out = np.full(len(counts), model.bias)
    if len(ids):
        bucket, grams = _subwords(vocab)
        spans, made = _spans(_means(model.weights[bucket], grams)[ids], counts)
        full = made > 0
        out[full] += _averages(spans, made[full], SHARP)[1]
    return out


def fit(texts: list[bytes], toxic: np.ndarray, prior: float) -> Model:
    """Joint training of embeddings and softmax on whole texts; ``prior`` is the share of
    toxic texts among all training labels (the sample is balanced)."""
    ids, counts, vocab = words.block_words(texts)
    keep = counts > 0
    counts, y = counts[keep], toxic[keep].astype(np.float64)
    if not len(ids) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((prior + 1e-4) / (1 - prior + 1e-4))))
    bucket, grams = _subwords(vocab)
    gram_word = np.repeat(np.arange(len(vocab), dtype=np.int32), grams)
    rng = np.random.default_rng(7)
    emb = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2)
    g_emb, g_soft, g_bias = np.full(BUCKETS, 1e-8), np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    _, made = _spans(np.zeros(len(ids)), counts)
    owner = np.repeat(np.arange(len(counts)), made)
    first = np.cumsum(made) - made
    start = np.arange(len(owner)) - first[owner] + (np.cumsum(counts) - counts)[owner]
    stop = np.minimum(start + SPAN, np.cumsum(counts)[owner])
    for step in range(STEPS):
        sharp = SHARP * min(1.0, step / (0.6 * STEPS))
        diff = (soft[:, 1] - soft[:, 0]).astype(np.float64)
        per_bucket = emb @ diff
        spans, _ = _spans(_means(per_bucket[bucket], grams)[ids], counts)
        w, text = _averages(spans, made, sharp)
        z = text + bias[1] - bias[0]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        # gradient of each token, then of each word, then of each bucket's score
        per_span = error[owner] * w / (stop - start)
        edge = np.bincount(start, per_span, len(ids) + 1) - np.bincount(stop, per_span, len(ids) + 1)
        per_word = np.bincount(ids, np.cumsum(edge[:-1]), len(vocab)) / grams
        per_score = np.bincount(bucket, per_word[gram_word], BUCKETS)
        d_diff = emb.T @ per_score
        g_emb += per_score ** 2
        used = np.flatnonzero(per_score)
        emb[used] -= (0.5 * (per_score[used] / np.sqrt(g_emb[used]))[:, None] * diff).astype(np.float32)
        d_soft = np.stack([-d_diff, d_diff], 1)
        g_soft += d_soft ** 2
        soft -= (0.05 * d_soft / np.sqrt(g_soft)).astype(np.float32)
        d_bias = np.array([-error.sum(), error.sum()])
        g_bias += d_bias ** 2
        bias -= 0.1 * d_bias / np.sqrt(g_bias)
    shift = float(np.log((prior + 1e-4) / (1 - prior + 1e-4)))
    diff = (soft[:, 1] - soft[:, 0]).astype(np.float64)
    return Model((emb @ diff).astype(np.float32), float(bias[1] - bias[0]) + 0.5 * shift)


def train(docs: DataFrame, labels: DataFrame, fold: int = 4, held: int = 2, sample: int = SAMPLE) -> Model:
    """Fit on labelled rows whose crc32(doc_id) mod ``fold`` is not ``held``: per class the
    ``sample`` ids with the smallest hash (bounds what reaches the driver). An id with several
    labels counts as toxic if one of them says so; several texts of one id are all taken."""
    known = (labels.select("doc_id", F.col("toxic").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)")
             .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold != held)
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    totals = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        part = (known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
        chosen = part if chosen is None else chosen.union(part)
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("text", "y", "doc_id").collect())
    rows.sort(key=lambda r: (r.doc_id, r.text))
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    return fit([r.text.encode() for r in rows], np.array([r.y for r in rows], np.int64), prior)


def score(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """``docs`` with a double column ``name`` (0 to 1) from the whole ``text``. Null and
    empty texts get the probability of the bias alone. All other columns pass unchanged;
    ``name`` must not be one of them. Empty tables give empty results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.text_blocks(batches, BLOCK_BYTES):
            p = 1 / (1 + np.exp(-np.clip(_logits(model, words.as_bytes(block.column("text"))), -30, 30)))
            yield from block.append_column(name, pa.array(p, pa.float64())).to_batches()
    return docs.mapInArrow(run, docs.select("*", F.lit(0.0).cast("double").alias(name)).schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, empty and long texts as in ``score``; a null doc_id is not held out; repeated
    rows are scored alike."""
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, tables.read(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return score(docs, model, "score").select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
