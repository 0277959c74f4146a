"""Log-bilinear language model, trained with noise-contrastive estimation in numpy.

Every text is encoded once into blocks of local word ids. All training tokens are counted
(one shuffle of each block's distinct words). The softmax is factored: P(unit | context) times
P(word | unit, context). The ``TOP`` most frequent words are units of their own, the others
belong to one of ``ENDINGS`` units by their last two bytes, which unseen words have as well.

The two units before a token are embedded, scaled by position and summed; their product with
the target embeddings plus a bias scores the next unit. Each block takes NCE gradient steps
over its own aggregated (context, unit) counts, and parameters are averaged over blocks by
their tokens. With the contexts fitted, every word inside a unit is learned too: it has an
embedding by its hash, in a table whose rows follow the vocabulary within ``ROWS``, fitted by
NCE against the unit's own word counts as noise. A word's probability within its unit is its
discounted count times exp(context . embedding), over the sum of that over all words of the
unit and the discounted mass, which stands for unseen words. The sum needs the counts by row
only and is taken once for every context, so token probabilities sum to one exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables, words

TOP = 96
ENDINGS = 32
UNITS = TOP + ENDINGS
BLOCK_BYTES = 32 << 20    # longer blocks share more words: fewer counted rows
START = UNITS            # the unit before a text begins
DIM = 16
ROUNDS = 2
BATCH = 8192
NOISE = 64               # noise units drawn per batch, shared by its rows
RATIO = 8.0              # noise samples per data token that they stand for
DISCOUNT = 0.6
ROWS = 1 << 12, 1 << 16  # fewest and most rows of word embeddings; no word is without one
WORDS_A_ROW = 4          # words sharing a row between those
EPOCHS = 2               # passes over a block's tokens, for word embeddings
DRAWS = 2                # noise rows drawn for a token, standing for RATIO samples
PRIOR = 10.0             # gradients grow from here: a row seen a few times stays near zero
CHUNK = 1 << 18          # tokens scored together
PIECE = 1 << 18          # numbers of a sum in one shuffled row
END = 0x5EED_0F_7E47     # stands for the hash of the end token

BLOCKS = ("block string, doc_ids array<bigint>, held array<boolean>, counts array<int>, ids binary, "
          "hashes binary, endings binary, train binary")
SHAPES = {"context": (UNITS + 1, DIM), "target": (UNITS, DIM), "position": (2, DIM), "bias": (UNITS,)}


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for n, block in enumerate(words.text_blocks(batches, BLOCK_BYTES)):
        local, counts, vocab = words.block_words(words.as_bytes(block.column("text")))
        ids = np.full(len(local) + len(counts), len(vocab), np.int32)
        ids[np.arange(len(local)) + np.repeat(np.arange(len(counts)), counts)] = local
        counts = counts + 1
        held = block.column("held").combine_chunks()
        learn = np.repeat(~held.to_numpy(zero_copy_only=False), counts)
        hashes = np.append(words.hash_words(vocab), np.uint64(END))
        tails = {t: hash_ % ENDINGS for t, hash_ in _tail_hashes(vocab)}
        endings = np.fromiter((tails[w[-2:]] for w in vocab), np.uint8, len(vocab))
        yield pa.RecordBatch.from_arrays([
            pa.array([f"{part}-{n}"]), pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            pa.array([held.to_pylist()], pa.list_(pa.bool_())), pa.array([counts], pa.list_(pa.int32())),
            pa.array([ids.tobytes()], pa.binary()), pa.array([hashes.tobytes()], pa.binary()),
            pa.array([np.append(endings, 0).astype(np.uint8).tobytes()], pa.binary()),
            pa.array([np.bincount(ids[learn], minlength=len(hashes)).astype(np.int32).tobytes()], pa.binary())],
            ["block", "doc_ids", "held", "counts", "ids", "hashes", "endings", "train"])


def _tail_hashes(vocab: list[bytes]) -> Iterator[tuple[bytes, int]]:
    tails = list({w[-2:] for w in vocab})
    return zip(tails, words.hash_words(tails, 1).tolist())


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct word of a block."""
    for batch in batches:
        for block, hashes, endings, train in zip(*(c.to_pylist() for c in batch.columns)):
            h = np.frombuffer(hashes, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(h)), pa.array(np.arange(len(h), dtype=np.int32)), pa.array(h),
                 pa.array(np.frombuffer(endings, np.uint8).astype(np.int32)),
                 pa.array(np.frombuffer(train, np.int32).astype(np.int64))],
                ["block", "at", "hash", "ending", "c"])


def _units(hashes: bytes, endings: bytes, top: np.ndarray) -> np.ndarray:
    """Unit of each distinct word; ``top`` has the sorted hashes of the frequent words."""
    h = np.frombuffer(hashes, np.int64)
    unit = TOP + np.frombuffer(endings, np.uint8).astype(np.int64)
    if len(top):
        at = np.minimum(np.searchsorted(top, h), len(top) - 1)
        unit = np.where(top[at] == h, at, unit)
    return unit.astype(np.int32)         # codes of contexts and units fit as well


def _contexts(units: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(unit before) * (UNITS + 1) + (unit before that) for every token."""
    begin = np.cumsum(counts) - counts
    code = np.roll(units, 1)
    code[begin] = START
    two = np.roll(code, 1)
    two[begin] = START
    code *= UNITS + 1
    code += two
    return code


def _unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        out[name] = flat[at:at + math.prod(shape)].reshape(shape).astype(np.float32)
        at += math.prod(shape)
    return out


def _hidden(p: dict[str, np.ndarray], context: np.ndarray) -> np.ndarray:
    return (p["position"][0] * p["context"][context // (UNITS + 1)]
            + p["position"][1] * p["context"][context % (UNITS + 1)])


def nce(p: dict[str, np.ndarray], context: np.ndarray, unit: np.ndarray, weight: np.ndarray,
        noise: np.ndarray, rate: float, seed: int) -> None:
    """One pass of NCE steps (Adagrad) over weighted (context, unit) pairs, in place."""
    rng = np.random.default_rng(seed)
    log_noise = np.log(RATIO * noise).astype(np.float32)
    grown = {k: np.full_like(v, 1e-6) for k, v in p.items()}
    order = rng.permutation(len(unit))
    for lo in range(0, len(order), BATCH):
        pick = order[lo:lo + BATCH]
        c, u = context[pick], unit[pick]
        w = (weight[pick] / weight[pick].sum()).astype(np.float32)
        drawn = rng.choice(UNITS, NOISE, p=noise)
        h = _hidden(p, c)
        s = np.einsum("ij,ij->i", h, p["target"][u]) + p["bias"][u]
        good = w * (1 / (1 + np.exp(np.clip(s - log_noise[u], -30, 30))))
        t = h @ p["target"][drawn].T + p["bias"][drawn]
        bad = (w * RATIO / NOISE)[:, None] / (1 + np.exp(-np.clip(t - log_noise[drawn], -30, 30)))
        dh = good[:, None] * p["target"][u] - bad @ p["target"][drawn]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        np.add.at(g["target"], u, good[:, None] * h)
        np.add.at(g["target"], drawn, -(bad.T @ h))
        np.add.at(g["bias"], u, good)
        np.add.at(g["bias"], drawn, -bad.sum(0))
        for k, at in enumerate((c // (UNITS + 1), c % (UNITS + 1))):
            np.add.at(g["context"], at, p["position"][k] * dh)
            g["position"][k] = (dh * p["context"][at]).sum(0)
        for k in p:
            grown[k] += g[k] ** 2
            p[k] += (rate * g[k] / np.sqrt(grown[k])).astype(np.float32)


def nce_rows(rows: np.ndarray, p: dict[str, np.ndarray], context: np.ndarray, row: np.ndarray, share: np.ndarray,
             rate: float, seed: int) -> None:
    """NCE steps (Adagrad) for the word embeddings ``rows`` of one unit, in place, over the context
    and row of every token; ``share``: the noise, each row's part of the unit."""
    rng = np.random.default_rng(seed)
    upto = np.cumsum(share) / share.sum()
    last = int(np.flatnonzero(share)[-1])
    grown = np.full(rows.shape, PRIOR, np.float32)
    dims = np.arange(DIM)
    for _ in range(EPOCHS):
        order = rng.permutation(len(row))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            drawn = np.minimum(np.searchsorted(upto, rng.random(DRAWS * len(pick)), "right"), last)
            at = np.concatenate([row[pick], drawn])
            h = np.concatenate([_hidden(p, context[pick])] * (1 + DRAWS))
            odds = np.exp(np.clip(np.einsum("ij,ij->i", h, rows[at]) - math.log(RATIO), -30, 30))
            pull = 1 / (1 + odds)
            pull[len(pick):] = (pull[len(pick):] - 1) * (RATIO / DRAWS)
            g = np.bincount((at[:, None] * DIM + dims).ravel(), (pull[:, None] * h).ravel(), rows.size)
            g = g.reshape(rows.shape).astype(np.float32)
            grown += g ** 2
            rows += rate * g / np.sqrt(grown)


def _row(hashes: np.ndarray, unit: np.ndarray, a_unit: int) -> np.ndarray:
    """Row of each distinct word; -1 for words that are units of their own."""
    return np.where(unit >= TOP, (unit - TOP) * a_unit + (hashes & (a_unit - 1)), -1).astype(np.int32)


def _learn_rows(flat: np.ndarray, top: np.ndarray, mass: np.ndarray, rate: float):
    """Word embeddings fitted over the blocks of a task: sums, by piece, of rows times their
    tokens, then of the tokens. mass: discounted counts by row."""
    a_unit = len(mass) // ENDINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _unpack(flat)
        sums = np.zeros(len(mass) * (DIM + 1), np.float32)
        rows = np.zeros((len(mass), DIM), np.float32)
        for batch in batches:
            for held, counts, ids, hashes, endings in zip(*(c.to_pylist() for c in batch.columns)):
                counts, ids = np.asarray(counts, np.int64), np.frombuffer(ids, np.int32)
                unit = _units(hashes, endings, top)
                row = _row(np.frombuffer(hashes, np.int64), unit, a_unit)[ids]
                learn = np.flatnonzero(np.repeat(~np.asarray(held, bool), counts) & (row >= 0))
                learn = learn[np.argsort((row[learn] // a_unit).astype(np.uint8), kind="stable")]
                context, row = _contexts(unit[ids], counts)[learn], row[learn]
                cuts = np.searchsorted(row // a_unit, np.arange(ENDINGS + 1))
                for u in range(ENDINGS):
                    cut, base = slice(cuts[u], cuts[u + 1]), u * a_unit
                    if cuts[u] < cuts[u + 1]:
                        nce_rows(rows[base:base + a_unit], p, context[cut], row[cut] - base, mass[base:base + a_unit],
                                 rate, int(cuts[u + 1] - cuts[u]))
                sums[rows.size:] += np.bincount(row, minlength=len(mass)).astype(np.float32)
        tokens = sums[rows.size:]
        if tokens.any():
            sums[:rows.size] = (rows * tokens[:, None]).ravel()
            for lo in range(0, len(sums), PIECE):
                yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([sums[lo:lo + PIECE].tobytes()], pa.binary())],
                                                 ["at", "sums"])
    return run


def _add(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of a piece over tasks, one task's at a time."""
    at, out = 0, None
    for batch in pieces:
        for at, one in zip(batch.column("at").to_pylist(), batch.column("sums")):
            one = np.frombuffer(one.as_buffer(), np.float32)
            out = one.astype(np.float64) if out is None else out + one
    yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([out.astype(np.float32).tobytes()], pa.binary())], ["at", "sums"])


def _norms(flat: np.ndarray, rows: np.ndarray, mass: np.ndarray, unseen: np.ndarray):
    """By the unit before: log10 of every ending's sum of counts times exp(tilt), over its sum of
    counts, in all contexts with that unit."""
    p = _unpack(flat)
    weights = mass.reshape(ENDINGS, -1).astype(np.float32)
    sizes = weights.sum(1, dtype=np.float64) + unseen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column(0).to_pylist():
                h = _hidden(p, one * (UNITS + 1) + np.arange(UNITS + 1))
                norm = np.zeros((UNITS + 1, ENDINGS))
                for u in range(ENDINGS):
                    if sizes[u] > 0:
                        tilt = np.exp(_tilt(h @ rows[u * weights.shape[1]:(u + 1) * weights.shape[1]].T))
                        norm[:, u] = np.log10((tilt @ weights[u] + unseen[u]) / sizes[u])
                yield pa.RecordBatch.from_arrays([pa.array([one]), pa.array([norm.tobytes()], pa.binary())], ["one", "norm"])
    return run


def _tilt(x: np.ndarray) -> np.ndarray:
    return np.clip(x, -30, 30)


def _learn(flat: np.ndarray, top: np.ndarray, noise: np.ndarray, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, counts, ids, hashes, endings in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.asarray(counts, np.int64)
                units = _units(hashes, endings, top)[np.frombuffer(ids, np.int32)]
                learn = np.repeat(~np.asarray(held, bool), counts)
                code = _contexts(units, counts)
                code *= UNITS
                code += units
                code = code[learn]
                if not len(code):
                    continue
                code, weight = np.unique(code, return_counts=True)
                p = _unpack(flat)
                nce(p, code // UNITS, code % UNITS, weight.astype(np.float64), noise, rate, len(code))
                out = np.concatenate([p[k].reshape(-1) for k in SHAPES])
                yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float32())),
                                                  pa.array([float(weight.sum())])], ["params", "weight"])
    return run


def _score(flat: np.ndarray, rows: np.ndarray, norms: np.ndarray, top: np.ndarray, size: np.ndarray,
           kinds: np.ndarray, total: int, distinct: int):
    """size, kinds: training tokens and distinct words of each ending's unit; norms: by context
    and ending, see ``_norms``."""
    p = _unpack(flat)
    floor = math.log10(total + 0.5 * (distinct + 1))

    def run(blocks: pa.Table, known: pa.Table) -> pa.Table:
        row = {c: blocks.column(c)[0].as_py() for c in blocks.column_names}
        ids = np.frombuffer(row["ids"], np.int32)
        counts = np.asarray(row["counts"], np.int64)
        unit = _units(row["hashes"], row["endings"], top)
        c = np.zeros(len(unit))
        c[known.column("at").to_numpy()] = known.column("c").to_numpy()
        ending = unit - TOP
        rare = ending >= 0
        inside = np.zeros(len(unit))
        held_by = np.maximum(size[ending[rare]], 1)
        mass = np.where(c[rare] > 0, c[rare] - DISCOUNT, DISCOUNT * kinds[ending[rare]])
        inside[rare] = np.where(size[ending[rare]] > 0, np.log10(np.maximum(mass, 1e-9) / held_by), 0.0)
        units = unit[ids]
        context, at = np.unique(_contexts(units, counts), return_inverse=True)
        hidden = _hidden(p, context)
        z = (hidden @ p["target"].T + p["bias"]).astype(np.float64)
        z -= z.max(1, keepdims=True)
        z = (z - np.log(np.exp(z).sum(1, keepdims=True))) / math.log(10)
        first = np.cumsum(counts) - counts
        base = np.log10(c + 0.5) - floor
        score = z[at, units] + inside[ids]
        own = _row(np.frombuffer(row["hashes"], np.int64), unit, len(rows) // ENDINGS)
        own = np.where(c > 0, own, -1)                       # unseen words are not tilted
        for lo in range(0, len(ids), CHUNK):
            mine = own[ids[lo:lo + CHUNK]]
            seen, inner = np.flatnonzero(mine >= 0), np.flatnonzero(units[lo:lo + CHUNK] >= TOP) + lo
            score[seen + lo] += _tilt(np.einsum("ij,ij->i", hidden[at[seen + lo]], rows[mine[seen]])) / math.log(10)
            score[inner] -= norms[context[at[inner]], units[inner] - TOP]
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
            "n_tokens": counts, "n_known": np.add.reduceat((c > 0).astype(np.int64)[ids], first),
            "base_score": np.add.reduceat(base[ids], first),
            "score": np.add.reduceat(score, first)})
    return run


def score_texts(docs: DataFrame, held: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities of the whole text).

    Learns from the rows where ``held`` is not true (null counts as false). Words are runs
    without ASCII blanks, A-Z lower-cased; every text ends with one end token, so null and
    empty texts are that token alone. Repeated rows count each; null ids stay null. Other
    columns are ignored; an empty table gives an empty result; with no training row every
    probability is that of an untrained model. Words are told apart by 64-bit hashes. Every
    training word is learned in its contexts; unseen words of an ending share its discounted
    mass as one outcome. A context's words beyond the ``TOP`` count as their endings.
    """
    spark = docs.sparkSession
    blocks = tables.scratch(docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held"), "text")
                            .mapInArrow(_encode, BLOCKS), "blocks")
    seen = blocks.select("block", "hashes", "endings", "train").mapInArrow(
        _words_of, "block string, at int, hash long, ending int, c long")
    vocab = tables.scratch(seen.filter("c > 0").groupBy("hash").agg(
        F.sum("c").alias("c"), F.max("ending").alias("ending")), "vocabulary")
    frequent = vocab.orderBy(F.desc("c"), "hash").limit(TOP).collect()
    top = np.array(sorted(r.hash for r in frequent), np.int64)
    rest = vocab.groupBy("ending").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    size, kinds = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for r in rest:
        size[r.ending], kinds[r.ending] = r.c, r.v
    total, distinct = int(size.sum()), int(kinds.sum())
    weight = np.zeros(UNITS)
    for r in frequent:
        size[r.ending] -= r.c
        kinds[r.ending] -= 1
        weight[np.searchsorted(top, r.hash)] = r.c
    weight[TOP:] = size
    noise = (weight + 0.5) / (weight + 0.5).sum()

    rng = np.random.default_rng(11)
    start = {k: rng.normal(0, 0.1, v) for k, v in SHAPES.items()}
    start["position"][:] = 1.0
    start["bias"] = np.log(noise)
    flat = np.concatenate([start[k].reshape(-1) for k in SHAPES]).astype(np.float32)
    for n in range(ROUNDS):
        fits = blocks.select("held", "counts", "ids", "hashes", "endings").mapInArrow(
            _learn(flat, top, noise, 0.2 / (1 + n)), "params array<float>, weight double")
        mean = (fits.select(F.posexplode("params").alias("i", "v"), "weight").groupBy("i")
                .agg((F.sum(F.col("v") * F.col("weight")) / F.sum("weight")).alias("v")).collect())
        for r in mean:
            flat[r.i] = r.v

    a_unit = min(max(ROWS[0], 1 << (distinct // WORDS_A_ROW).bit_length()), ROWS[1]) // ENDINGS
    inside = (vocab.filter(~F.col("hash").isin(top.tolist())) if len(top) else vocab).groupBy(
        (F.col("ending") * a_unit + F.col("hash").bitwiseAND(F.lit(a_unit - 1))).alias("row")).agg(
        F.sum(F.col("c") - DISCOUNT).alias("mass")).toArrow()
    mass = np.zeros(ENDINGS * a_unit)
    mass[inside.column("row").to_numpy()] = inside.column("mass").to_numpy()
    pieces = (blocks.select("held", "counts", "ids", "hashes", "endings")
              .mapInArrow(_learn_rows(flat, top, mass, 0.2), "at long, sums binary")
              .groupBy("at").applyInArrow(_add, "at long, sums binary").collect())
    sums = np.zeros(len(mass) * (DIM + 1), np.float32)
    for r in pieces:
        one = np.frombuffer(r.sums, np.float32)
        sums[r.at:r.at + len(one)] = one
    tokens = sums[len(mass) * DIM:]
    rows = sums[:len(mass) * DIM].reshape(-1, DIM) / np.maximum(tokens, 1)[:, None]
    norms = np.zeros(((UNITS + 1) ** 2, ENDINGS), np.float32)
    for r in spark.range(0, UNITS + 1, 1, UNITS + 1).mapInArrow(
            _norms(flat, rows, mass, DISCOUNT * kinds), "one long, norm binary").collect():
        norms[r.one * (UNITS + 1):(r.one + 1) * (UNITS + 1)] = np.frombuffer(r.norm).reshape(-1, ENDINGS)

    known = seen.select("block", "at", "hash").join(vocab.select("hash", "c"), "hash").select("block", "at", "c")
    scored = (blocks.select("block", "doc_ids", "held", "counts", "ids", "hashes", "endings").groupBy("block")
              .cogroup(known.groupBy("block")).applyInArrow(
                  _score(flat, rows, norms, top, size, kinds, total, distinct),
                  "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                         "base_score", "score")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return score_texts(tables.read(spark, sf_dir, "documents"), held)
