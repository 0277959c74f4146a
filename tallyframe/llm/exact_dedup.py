"""Exact dedup against history through a minimal perfect hash.

The distinct digests of the historical rows are dealt into buckets; each bucket builds a
minimal perfect hash (levels of bit arrays: a digest takes the first level where it is alone
at its place; its slot is the rank of that bit). Slot s holds the full digest, the locator of
the winner (its id and length) and the number of rows. New rows are first grouped by digest;
each group looks its slot up and compares all 32 bytes: equal means a repeat of history, and
the better winner stays; otherwise the group is new and stands by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables, words

BUCKET = 1024                          # historical digests per perfect hash, about
BLANKS = b" \t\n\x0b\x0c\r"
_LAST = 2**63 - 1                      # stands for a null id: any id is smaller

GROUPS = "digest binary, chars long, id long, n long"
TABLE = "bucket long, sizes array<int>, bits binary, digests binary, chars binary, ids binary, ns binary"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in words.text_blocks(batches):
        digests, chars = [], []
        for text in words.as_bytes(block.column("text")):
            digests.append(hashlib.sha256(text.translate(None, BLANKS)).digest())
            raw = np.frombuffer(text, np.uint8)
            chars.append(len(raw) - int(np.count_nonzero((raw & 0xC0) == 0x80)))
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id").combine_chunks().cast(pa.int64()), block.column("old").combine_chunks(),
             pa.array(digests, pa.binary()), pa.array(chars, pa.int64())], ["doc_id", "old", "digest", "chars"])


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = words.mix64(keys[:, 0] + np.uint64(level) * (keys[:, 1] | np.uint64(1)))
    return (mixed % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(level sizes, bits of all levels, slot of each key) for distinct 128-bit keys."""
    slot = np.empty(len(keys), np.int64)
    left, sizes, bits, used = np.arange(len(keys)), [], [], 0
    while len(left):
        size = max(2, 2 * len(left))
        place = _places(keys[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        mine = alone[place]
        slot[left[mine]] = used + (np.cumsum(alone) - 1)[place[mine]]
        used += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~mine]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slot


def look_up(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 where no level claims it. A strange key may get a slot too:
    the caller compares the digest stored there."""
    rank = np.cumsum(bits) - 1
    slot = np.full(len(keys), -1, np.int64)
    left, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        place = base + _places(keys[left], level, size)
        hit = bits[place]
        slot[left[hit]] = rank[place[hit]]
        left, base = left[~hit], base + size
    return slot


def _keys(digests: list[bytes] | pa.Array) -> np.ndarray:
    raw = b"".join(digests if isinstance(digests, list) else digests.to_pylist())
    return np.frombuffer(raw, np.uint64).reshape(-1, 4)[:, 1:3]


def _build(table: pa.Table) -> pa.Table:
    digests = table.column("digest").to_pylist()
    sizes, bits, slot = build_hash(_keys(digests))
    order = np.argsort(slot)
    held = lambda c: table.column(c).to_numpy()[order].astype(np.int64).tobytes()
    return pa.table({
        "bucket": table.column("bucket").slice(0, 1), "sizes": pa.array([sizes], pa.list_(pa.int32())),
        "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
        "digests": pa.array([b"".join(digests[i] for i in order)], pa.binary()),
        "chars": pa.array([held("chars")], pa.binary()), "ids": pa.array([held("id")], pa.binary()),
        "ns": pa.array([held("n")], pa.binary())})


def _resolve(new: pa.Table, history: pa.Table) -> pa.Table:
    """Groups of one bucket: every slot of history, merged with its repeats, and the rest."""
    digests = new.column("digest").to_pylist()
    chars, ids, ns = (new.column(c).to_numpy().astype(np.int64) for c in ("chars", "id", "n"))
    if not history.num_rows:
        return pa.table({"digest": pa.array(digests, pa.binary()), "chars": chars, "id": ids, "n": ns})
    row = {c: history.column(c)[0].as_py() for c in history.column_names}
    held = [row["digests"][i:i + 32] for i in range(0, len(row["digests"]), 32)]
    h_chars, h_ids, h_ns = (np.frombuffer(row[c], np.int64).copy() for c in ("chars", "ids", "ns"))
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:sum(row["sizes"])].astype(bool)
    slot = look_up(_keys(digests), row["sizes"], bits) if digests else np.empty(0, np.int64)
    member = np.fromiter((s >= 0 and held[s] == d for s, d in zip(slot.tolist(), digests)), bool, len(digests))
    at = slot[member]
    better = (chars[member] > h_chars[at]) | ((chars[member] == h_chars[at]) & (ids[member] < h_ids[at]))
    h_chars[at[better]], h_ids[at[better]] = chars[member][better], ids[member][better]
    h_ns[at] += ns[member]
    fresh = np.flatnonzero(~member)
    return pa.table({
        "digest": pa.array(held + [digests[i] for i in fresh], pa.binary()),
        "chars": np.concatenate([h_chars, chars[fresh]]), "id": np.concatenate([h_ids, ids[fresh]]),
        "n": np.concatenate([h_ns, ns[fresh]])})


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner (most code points, then smallest id) and the row count."""
    best = F.max(F.struct("chars", (-F.coalesce("doc_id", F.lit(_LAST))).alias("id"))).alias("m")
    return rows.groupBy("digest").agg(best, F.count(F.lit(1)).alias("n")).select(
        "digest", "m.chars", (-F.col("m.id")).alias("id"), "n")


def exact_duplicates(docs: DataFrame, old: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII blanks; null counts as empty, so null and
    blank texts form one group. Of equal texts the row with the most code points, then the
    smallest doc_id stays. ``old`` marks the historical rows (the rest arrives later); the
    result does not depend on it. Repeated rows are members like any other; a null doc_id
    wins only where no other id ties and then gives a null keep_id. Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = tables.scratch(docs.select("doc_id", F.coalesce(old, F.lit(False)).alias("old"), "text").mapInArrow(
        _digest, "doc_id long, old boolean, digest binary, chars long"), "digests")
    distinct = rows.filter("old").agg(F.approx_count_distinct("digest").alias("n")).first().n
    bucket = F.pmod(F.xxhash64("digest"), F.lit(max(1, distinct // BUCKET))).alias("bucket")
    history = tables.scratch(_groups(rows.filter("old")).select(bucket, "*")
                             .groupBy("bucket").applyInArrow(_build, TABLE), "history")
    new = _groups(rows.filter("NOT old")).select(bucket, "*")
    groups = (new.groupBy("bucket").cogroup(history.groupBy("bucket")).applyInArrow(_resolve, GROUPS)
              .select("digest", F.when(F.col("id") < _LAST, F.col("id")).alias("keep_id"),
                      F.col("n").alias("group_size")))
    groups = tables.scratch(groups, "groups")
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History: the lower half of the id range; the upper half arrives afterwards."""
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    middle = docs.agg(((F.min("doc_id") + F.max("doc_id")) / 2).alias("m")).first().m
    return exact_duplicates(docs, F.col("doc_id") < F.lit(middle))


OP9_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS kept,
       text_sha256
FROM n
"""
