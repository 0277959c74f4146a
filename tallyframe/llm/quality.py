"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, ``FILTERS`` learned filters of ``WIDTH`` bytes slide with ``STRIDE`` over
the whole text, and their activations are max-pooled over chunks of two hops (``HOP`` bytes
each) that overlap by one hop, so every byte lies in a chunk. A small hidden layer turns the
pooled maxima of a chunk (and how much of it is text) into a logit; the text's probability
is the sigmoid of the mean chunk logit. Convolution, hidden layer and output are trained
together by back-propagation (Adam).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables, words

WIDTH, STRIDE, EMBED, FILTERS, HIDDEN = 8, 2, 6, 32, 16
HOP = 128
SLAB = 1024       # hops convolved at once
SAMPLE = 1500     # labelled training texts per class, at most: bounds the fit on the driver
EPOCHS = 6
BATCH = 24        # texts per step

Params = dict[str, np.ndarray]


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes in rows of one hop plus look-ahead, hops per text, text share of each hop).
    Each text is padded with at least ``WIDTH`` zero bytes up to whole hops."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    hops = (size + WIDTH + HOP - 1) // HOP
    flat = np.zeros(int(hops.sum()) * HOP + WIDTH, np.uint8)
    first = (np.cumsum(hops) - hops) * HOP
    for text, at in zip(texts, first.tolist()):
        flat[at:at + len(text)] = np.frombuffer(text, np.uint8)
    owner = np.repeat(np.arange(len(texts)), hops)
    inside = np.arange(len(owner)) * HOP - first[owner]
    return flat, hops, np.clip((size[owner] - inside) / HOP, 0, 1)


def _windows(flat: np.ndarray, a: int, b: int) -> np.ndarray:
    """Byte windows (positions, WIDTH) that start in hops a..b-1."""
    part = flat[a * HOP:b * HOP + WIDTH]
    return np.lib.stride_tricks.sliding_window_view(part, WIDTH)[:(b - a) * HOP:STRIDE]


def _pool(p: Params, flat: np.ndarray, a: int, b: int, where: bool = False):
    win = _windows(flat, a, b)
    x = p["embed"][win].reshape(len(win), WIDTH * EMBED)
    act = (x @ p["filters"]).reshape(b - a, HOP // STRIDE, FILTERS)
    if not where:
        return act.max(1)
    at = act.argmax(1)
    return np.take_along_axis(act, at[:, None], 1)[:, 0], at


def _chunks(hops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of first hop, of last hop) of each chunk, chunks per text = max(1, hops - 1)."""
    made = np.maximum(1, hops - 1)
    owner = np.repeat(np.arange(len(hops)), made)
    one = np.arange(len(owner)) - (np.cumsum(made) - made)[owner] + (np.cumsum(hops) - hops)[owner]
    return one, np.minimum(one + 1, (np.cumsum(hops) - 1)[owner])


def _head(p: Params, best: np.ndarray, share: np.ndarray):
    f = np.maximum(0, best + p["bias"])
    f = np.concatenate([f, share[:, None]], 1)
    h = np.tanh(f @ p["hidden"] + p["hidden_bias"])
    return f, h, h @ p["out"] + p["out_bias"]


def logits(p: Params, texts: list[bytes]) -> np.ndarray:
    flat, hops, share = _layout(texts)
    top = np.empty((int(hops.sum()), FILTERS), np.float32)
    for a in range(0, len(top), SLAB):
        b = min(a + SLAB, len(top))
        top[a:b] = _pool(p, flat, a, b)
    one, two = _chunks(hops)
    _, _, z = _head(p, np.maximum(top[one], top[two]), (share[one] + share[two]) / 2)
    made = np.maximum(1, hops - 1)
    return np.add.reduceat(z, np.cumsum(made) - made) / made if len(made) else z


def fit(texts: list[bytes], good: np.ndarray, prior: float) -> Params:
    """Train on whole texts; ``prior`` is the share of label 1 among all training labels."""
    rng = np.random.default_rng(3)
    p = {"embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, 0.25, (WIDTH * EMBED, FILTERS)),
         "bias": np.zeros(FILTERS), "hidden": rng.normal(0, 0.2, (FILTERS + 1, HIDDEN)),
         "hidden_bias": np.zeros(HIDDEN), "out": rng.normal(0, 0.2, HIDDEN), "out_bias": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    shift = float(np.log((prior + 1e-4) / (1 - prior + 1e-4)))
    if not len(texts) or good.min() == good.max():
        p["out"][:] = 0
        p["out_bias"][:] = shift
        return p
    weight = np.where(good == 1, 0.5 / good.mean(), 0.5 / (1 - good.mean()))
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    epochs = max(EPOCHS, int(np.ceil(400 * BATCH / len(texts))))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            g = _gradient(p, [texts[i] for i in pick], good[pick], weight[pick])
            step += 1
            rate = 0.01 * (1 - (epoch * len(order) + lo) / (epochs * len(order))) + 3e-4
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.99 * s[k] + 0.01 * g[k] ** 2
                p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                         / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    p["out_bias"] += np.float32(0.5 * shift)
    return p


def _gradient(p: Params, texts: list[bytes], good: np.ndarray, weight: np.ndarray) -> Params:
    flat, hops, share = _layout(texts)
    n = int(hops.sum())
    top = np.empty((n, FILTERS), np.float32)
    at = np.empty((n, FILTERS), np.int64)
    for a in range(0, n, SLAB):
        b = min(a + SLAB, n)
        top[a:b], at[a:b] = _pool(p, flat, a, b, True)
    one, two = _chunks(hops)
    later = top[two] > top[one]
    best = np.where(later, top[two], top[one])
    f, h, z = _head(p, best, (share[one] + share[two]) / 2)
    made = np.maximum(1, hops - 1)
    owner = np.repeat(np.arange(len(hops)), made)
    mean = np.add.reduceat(z, np.cumsum(made) - made) / made
    d_text = weight * (1 / (1 + np.exp(-np.clip(mean, -30, 30))) - good) / len(texts)
    dz = (d_text / made)[owner].astype(np.float32)
    g = {"out": h.T @ dz, "out_bias": np.array([dz.sum()])}
    dh = dz[:, None] * p["out"] * (1 - h * h)
    g["hidden"], g["hidden_bias"] = f.T @ dh, dh.sum(0)
    df = (dh @ p["hidden"].T)[:, :FILTERS] * (f[:, :FILTERS] > 0)
    g["bias"] = df.sum(0)
    # each pooled maximum comes from one window: scatter its gradient there
    hop = np.where(later, two[:, None], one[:, None])
    place = hop * (HOP // STRIDE) + at[hop, np.arange(FILTERS)]
    chunk, which = np.nonzero(df)
    win = np.lib.stride_tricks.sliding_window_view(flat, WIDTH)[place[chunk, which] * STRIDE]
    d = df[chunk, which].astype(np.float32)
    x = p["embed"][win].reshape(len(win), WIDTH * EMBED)
    g["filters"] = np.empty_like(p["filters"])
    spread = np.zeros((len(win), WIDTH * EMBED), np.float32)
    for j in range(FILTERS):
        own = which == j
        g["filters"][:, j] = d[own] @ x[own]
        spread[own] = d[own][:, None] * p["filters"][:, j]
    spread = spread.reshape(-1, EMBED)
    byte = win.reshape(-1)
    g["embed"] = np.stack([np.bincount(byte, spread[:, e], 256) for e in range(EMBED)], 1)
    return g


def train(docs: DataFrame, labels: DataFrame, fold: int = 3, held: int = 1) -> Params:
    """Fit on labelled rows whose crc32(doc_id) mod ``fold`` is not ``held``: per class the
    ``SAMPLE`` rows with the smallest hash of the id (bounds what reaches the driver)."""
    known = (labels.select("doc_id", F.col("quality").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)")
             .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold != held)
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    totals = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    low = known.filter("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    high = known.filter("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(low.union(high)), "doc_id").select("text", "y", "doc_id").collect())
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return fit([r.text.encode() for r in rows], np.array([r.y for r in rows], np.int64),
               totals.get(1, 0) / max(1, sum(totals.values())))


def score(docs: DataFrame, model: Params, name: str = "quality") -> DataFrame:
    """``docs`` with a double column ``name`` (0 to 1) from the whole ``text``; null counts
    as empty, which is scored as one chunk of padding. Other columns pass unchanged and
    must not be called ``name``; empty tables give empty results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.text_blocks(batches, 8 << 20):
            z = logits(model, list(words.as_bytes(block.column("text"))))
            p = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
            yield from block.append_column(name, pa.array(p, pa.float64())).to_batches()
    return docs.mapInArrow(run, docs.select("*", F.lit(0.0).cast("double").alias(name)).schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, tables.read(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return score(docs, model, "score").select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
