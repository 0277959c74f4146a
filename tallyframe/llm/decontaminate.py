"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared after lower-casing A-Z and writing every run of ASCII blanks as one
space. An item of m characters may differ by ``rate * m`` edits (k); cut into k + 1 pieces,
at least one piece survives any k edits unchanged. Exact piece hits over the whole text come
from one Aho-Corasick pass; hits on nearby diagonals form a window, and Myers' bit-parallel
distance of the whole item inside the window decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables, words

RATE = 0.06
LEAST = 20              # items of fewer normalised characters are searched for as whole words, without edits
SLAB_CHARS = 512 << 10  # item characters per pass over the documents: bounds the automaton

HITS = "doc_id long, item_id long, distance int, start long, end long"


def normalise(text: bytes) -> str:
    return b" ".join(text.lower().split()).decode()


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 pieces of near-equal length."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str) -> tuple[int, int]:
    """(least edit distance of ``item`` to any substring of ``text``, first end of one)."""
    m = len(item)
    eq: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(item):
        eq[ch] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, dist = full, 0, m
    best, at = m, 0
    for j, ch in enumerate(text):
        e = eq.get(ch, 0)
        diag = (((e & up) + up) ^ up) | e | down
        plus = down | (full & ~(diag | up))
        minus = up & diag
        if plus & top:
            dist += 1
        elif minus & top:
            dist -= 1
        plus = (plus << 1) & full        # a match may start anywhere: no carry into row 0
        minus = (minus << 1) & full
        step = e | down
        up = minus | (full & ~(step | plus))
        down = plus & step
        if dist < best:
            best, at = dist, j + 1
    return best, at


def _windows(diagonals: list[int], m: int, k: int) -> Iterator[tuple[int, int, int]]:
    """(from, to, first diagonal) of the stretches in which the item may lie."""
    diagonals = sorted(set(diagonals))
    a = b = diagonals[0]
    for d in diagonals[1:]:
        if d - b > 2 * k + 1:
            yield a - k, b + m + k, a
            a = d
        b = d
    yield a - k, b + m + k, a


def _whole_words(text: str, diagonals: list[int], m: int) -> int | None:
    """First of the places at which ``m`` characters begin and end at word borders."""
    return min((d for d in diagonals if not (d and text[d - 1].isalnum()) and not text[d + m:d + m + 1].isalnum()), default=None)


def _search(items: list[tuple[int, str]], rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        budget = [int(rate * len(t)) if len(t) >= LEAST else 0 for _, t in items]
        for n, (_, text) in enumerate(items):
            for at, piece in pieces(text, budget[n]):
                owners[piece].append((n, at + len(piece) - 1))
        automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            automaton.add_word(piece, where)
        automaton.make_automaton()
        for block in words.text_blocks(batches):
            rows = []
            for doc_id, raw in zip(block.column("doc_id").to_pylist(), words.as_bytes(block.column("text"))):
                text = normalise(raw)
                found = defaultdict(list)
                for end, where in automaton.iter(text):
                    for n, last in where:
                        found[n].append(end - last)
                for n, diagonals in found.items():
                    item_id, item = items[n]
                    m, k = len(item), budget[n]
                    if m < LEAST:
                        at = _whole_words(text, diagonals, m)
                        if at is not None:
                            rows.append((doc_id, item_id, 0, at, at + m))
                        continue
                    best = None
                    for a, b, d in _windows(diagonals, m, k):
                        if text.startswith(item, max(0, d)) and d >= 0:
                            hit = (0, d, d + m)
                        else:
                            a = max(0, a)
                            dist, end = myers(item, text[a:b])
                            hit = (dist, max(0, a + end - m), a + end)
                        if hit[0] <= k and (best is None or hit < best):
                            best = hit
                    if best:
                        rows.append((doc_id, item_id, *best))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             ["doc_id", "item_id", "distance", "start", "end"])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per document row and benchmark item found in it: doc_id, item_id, distance
    (edits, at most ``rate`` of the item's length), start and end of the best place in the
    normalised text (for distance above 0 the start is end - item length).

    The benchmark is the stated query set: it is read in slabs of ``SLAB_CHARS`` characters,
    one pass over the documents each. Items of fewer than ``LEAST`` normalised characters,
    where an edit could make another word, are found without edits and between word borders
    (no letter or digit before or after). Null and empty texts hold nothing, null and blank
    items are in nothing; repeated items and rows are reported each; of several places the
    one with the fewest edits, then the first, is given; a null doc_id stays null. Texts of
    any length are searched whole. Other columns are ignored; an empty table on either side
    gives an empty result.
    """
    slabs: list[list[tuple[int, str]]] = [[]]
    size = 0
    for r in benchmark.select("item_id", "text").filter("text IS NOT NULL").toLocalIterator():
        text = normalise(r.text.encode())
        if not text:
            continue
        if size + len(text) > SLAB_CHARS and slabs[-1]:
            slabs.append([])
            size = 0
        slabs[-1].append((r.item_id, text))
        size += len(text)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not slabs[-1]:
        return source.limit(0).selectExpr("doc_id", "0L item_id", "0 distance", "0L start", "0L end")
    out = None
    for slab in slabs:
        part = source.mapInArrow(_search(slab, rate), HITS)
        out = part if out is None else out.unionByName(part)
    return out


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks of ``benchmark`` in ``documents``; nulls, short items, ties and repeated rows as
    ``find_leaks`` says."""
    return find_leaks(tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "benchmark"))
