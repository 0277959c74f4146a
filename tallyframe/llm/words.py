"""Block tokenizer shared by the word-level operators.

A *block* is a bounded run of rows inside one Arrow stream. Each block holds its words as
local ids into the block's own dictionary, so every distinct word is hashed (or encoded)
once per block and all later work is vectorised numpy over ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 12 << 20  # text bytes per block: bounds a task's memory, whatever its split holds


class _Ids(dict):
    """word -> next free id on first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def text_blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Regroup Arrow batches (with a ``text`` column) into tables of about ``limit`` text
    bytes. A longer single text forms a block of its own; no text is cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.fromiter((0 if v is None else v for v in
                               pc.binary_length(batch.column("text")).to_pylist()),
                              np.int64, batch.num_rows)
        start = 0
        while start < batch.num_rows:
            room = np.cumsum(lengths[start:]) + size
            take = int(np.searchsorted(room, limit, "right"))
            if take == 0 and held:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                continue
            take = max(1, take)
            held.append(batch.slice(start, take))
            size += int(lengths[start:start + take].sum())
            start += take
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def as_bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, one at a time; null counts as empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    for chunk in chunks:
        for value in chunk.cast(pa.large_binary() if pa.types.is_large_string(chunk.type)
                                else pa.binary()):
            yield value.as_py() or b""


def block_words(texts: Iterable[bytes], lower: bool = True
                ) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(ids of all words in order, words per text, the block's distinct words by id).

    Words are maximal runs without the six ASCII blanks (``bytes.split``); ``lower``
    lower-cases A-Z only (``bytes.lower``).
    """
    known = _Ids()
    get = known.__getitem__
    parts, counts = [], []
    for text in texts:
        words = (text.lower() if lower else text).split()
        counts.append(len(words))
        parts.append(np.fromiter(map(get, words), np.int32, len(words)))
    ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return ids, np.asarray(counts, np.int64), list(known)


def hash_words(words: list[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hash of each distinct word (the same in every process and run)."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits (wrap-around arithmetic)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


SLAB = 4096  # texts whose shingles are sorted together: owner in 12 bits, hash in 52


def shingles(ids: np.ndarray, counts: np.ndarray, hashes: np.ndarray, k: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """(distinct 52-bit shingle hashes, grouped by text and sorted within; set size per text).

    A text with 1..k-1 words has one shingle, its whole sequence; one without words none.
    """
    out, sizes = [], []
    ends = np.cumsum(counts)
    for a in range(0, len(counts), SLAB):
        n = counts[a:a + SLAB]
        lo = int(ends[a] - counts[a])
        v = hashes[ids[lo:int(ends[min(a + SLAB, len(counts)) - 1])]]
        stop = np.cumsum(n)
        owner = np.repeat(np.arange(len(n), dtype=np.uint64), n)
        acc = v.copy()
        for j in range(1, k):
            acc *= np.uint64(0x9E3779B97F4A7C15)
            if j < len(v):
                acc[:-j] += v[j:]
        whole = np.ones(len(v), bool)      # positions with k words left in their text
        for j in range(1, k):
            whole[(stop - j)[n >= j]] = False
        acc, owner = acc[whole], owner[whole]
        short = np.flatnonzero((n > 0) & (n < k))
        if len(short):
            extra = np.empty(len(short), np.uint64)
            for at, doc in enumerate(short):
                h = np.asarray([n[doc]], np.uint64)
                for x in range(stop[doc] - n[doc], stop[doc]):
                    h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + v[x:x + 1])
                extra[at] = h[0]
            acc = np.concatenate([acc, extra])
            owner = np.concatenate([owner, short.astype(np.uint64)])
        packed = (owner << np.uint64(52)) | (mix64(acc) >> np.uint64(12))
        packed.sort()
        if len(packed):
            keep = np.ones(len(packed), bool)
            np.not_equal(packed[1:], packed[:-1], out=keep[1:])
            packed = packed[keep]
        sizes.append(np.bincount((packed >> np.uint64(52)).astype(np.int64), minlength=len(n)))
        out.append(packed & np.uint64((1 << 52) - 1))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out), np.concatenate(sizes).astype(np.int64)
