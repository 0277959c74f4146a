"""BPE encoding and decoding through a table of distinct words.

Encoding. Texts are split at blanks in blocks of about ``BLOCK_BYTES``. A block keeps two
things: the numbers of its words in order (one compressed row), and its distinct words,
dealt by hash to buckets. A bucket's words from all blocks make its share of the word table:
the distinct ones meet the tokenizer once, and every block gets the ids of its words back.
Blocks and buckets are joined by block; a block's ids are picked by position from its
numbers. Buckets grow in number with the input, not in size.

Decoding. Ids are joined with the id-to-piece table of the tokenizer and a document's pieces
are written one after the other. That table is the tokenizer's vocabulary: it does not grow
with the data, and its size is checked before tasks get a copy.

Only the distinct words of each block and coded numbers are shuffled, never the texts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables, words
from .token_file import _block_words, _gather, _ragged, _spans

BLOCK_BYTES = 12 << 20     # text bytes that share one list of distinct words
PIECES_BYTES = 64 << 20    # largest id-to-piece table that tasks may copy
BUCKET_BYTES = 8 << 20     # text bytes for each bucket of the word table
BATCH = 5_000              # words encoded at a time
CHUNK_IDS = 1 << 18        # ids placed or decoded at a time

NUMBERED = "block binary, ids binary, named binary, counts binary, numbers binary"
HELD = "block binary, bucket long, at binary, words binary"
CODED = "block binary, at binary, size binary, ids binary"


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, pa.Table, np.ndarray, np.ndarray, pa.Array]]:
    """(block's name, its rows, words per text, number of every word, distinct words), numbers
    by falling frequency. The name holds the task's place and the words themselves: it is
    unique, and another evaluation that dealt rows otherwise finds no block of that name."""
    for n, block in enumerate(words.text_blocks(batches, BLOCK_BYTES)):
        at, counts, vocab = _block_words(block.column("text").combine_chunks(), False)
        often = np.bincount(at, minlength=len(vocab))
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        vocab = vocab.take(pa.array(order[often[order] > 0]))
        name = xxhash.xxh3_128(f"{TaskContext.get().partitionId()} {n} ".encode())
        for buffer in vocab.buffers()[1:]:
            name.update(buffer or b"")
        numbers = rank[at]
        del at, rank, often, order
        pa.default_memory_pool().release_unused()
        yield name.digest(), block.select(["doc_id"]), counts, numbers, vocab


def _pack(values: np.ndarray | bytes) -> bytes:
    return pa.compress(values if isinstance(values, bytes) else values.tobytes(), "zstd", asbytes=True)


def _unpack(frame: bytes, kind) -> np.ndarray:
    """Values of a packed array; the frame's header states their size."""
    size = zstandard.frame_content_size(frame)
    return np.frombuffer(pa.decompress(frame, size, "zstd", asbytes=True) if size else b"", kind)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, block, counts, numbers, _ in _ranked(batches):
        ids = block.column("doc_id").combine_chunks().cast(pa.int64())
        cells = [ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), counts, numbers]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (name, *map(_pack, cells))],
                                         ["block", "ids", "named", "counts", "numbers"])


def _hold(buckets: int):
    """A block's distinct words, one row a bucket: their numbers and the words, line by line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, _, _, vocab in _ranked(batches):
            known = vocab.cast(pa.binary()).to_pylist()
            bucket = (words.hash_words(known) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for part in np.array_split(np.arange(len(first)), -(-len(first) // 256)) if len(first) else []:
                lists = [order[first[i]:first[i + 1] if i + 1 < len(first) else None] for i in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(name, pa.binary()), len(part)), pa.array(bucket[order[first[part]]]),
                     pa.array([_pack(x.astype(np.uint32)) for x in lists], pa.binary()),
                     pa.array([_pack(b"\n".join([known[i] for i in x.tolist()])) for x in lists], pa.binary())],
                    ["block", "bucket", "at", "words"])
    return run


def _lists(flat: np.ndarray, size: np.ndarray) -> pa.Array:
    """Binary values of ``size`` little-endian uint32 each."""
    ends = np.concatenate([[0], np.cumsum(size) * 4])
    large = ends[-1] >= 2**31
    out = pa.Array.from_buffers(pa.large_binary() if large else pa.binary(), len(size),
                                [None, pa.py_buffer(ends.astype(np.int64 if large else np.int32)),
                                 pa.py_buffer(flat.astype("<u4"))])
    return out


_TOKENIZERS: dict = {}     # of this worker process, by file


def _encode_words(path: str):
    """A bucket's rows -> ids of their words; every distinct word is encoded once."""
    def run(rows: pa.Table) -> pa.Table:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _TOKENIZERS:
            from tokenizers import Tokenizer
            _TOKENIZERS[path] = Tokenizer.from_file(path)
            _TOKENIZERS[path].no_truncation()
            _TOKENIZERS[path].no_padding()
        lists = [_unpack(x, np.uint8).tobytes().split(b"\n") for x in rows.column("words").to_pylist()]
        stop = np.cumsum([0] + [len(x) for x in lists])
        table = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
        del lists
        known, found = table.dictionary.cast(pa.string()), [(np.zeros(0, np.uint32), np.zeros(0, np.int64))]
        for a in range(0, len(known), BATCH):
            found.append(_ragged([e.ids for e in _TOKENIZERS[path].encode_batch_fast(
                known.slice(a, BATCH).to_pylist(), add_special_tokens=False)]))
        flat, size = (np.concatenate(x) for x in zip(*found))
        at = table.indices.to_numpy()
        mine = [at[a:b] for a, b in zip(stop, stop[1:])]
        return pa.table([rows.column("block"), rows.column("at"), pa.array([_pack(size[x]) for x in mine], pa.binary()),
                         pa.array([_pack(_gather(flat, size, x)) for x in mine], pa.binary())],
                        ["block", "at", "size", "ids"])
    return run


def _place(left: pa.Table, right: pa.Table) -> pa.Table:
    """Ids of a block's documents, from its numbers and its words' ids."""
    if not left.num_rows:
        raise RuntimeError("words without their block: the input's rows are not dealt alike twice")
    at, size, flat = (np.concatenate([np.zeros(0, kind), *[_unpack(x, kind) for x in right.column(name).to_pylist()]])
                      for name, kind in (("at", np.uint32), ("size", np.int64), ("ids", np.uint32)))
    order = np.argsort(at)
    if not np.array_equal(at[order], np.arange(len(order))):
        raise RuntimeError("a block's words are not complete")
    flat, size = _gather(flat, size, order), size[order]
    del at, order, right
    out = []
    for row in left.to_pylist():
        counts, numbers = _unpack(row["counts"], np.int64), _unpack(row["numbers"], np.uint32).astype(np.int64)
        if len(numbers) and numbers.max() >= len(size):
            raise RuntimeError("a block met the words of another: the input's rows are not dealt alike twice")
        stop = np.concatenate([[0], np.cumsum(counts)])
        ids = pa.array(_unpack(row["ids"], np.int64), mask=~_unpack(row["named"], bool))
        for a, b in _spans(counts, CHUNK_IDS):
            mine = numbers[stop[a]:stop[b]]
            total = np.concatenate([[0], np.cumsum(size[mine])])[stop[a:b + 1] - stop[a]]
            out.append(pa.table([ids.slice(a, b - a), _lists(_gather(flat, size, mine), np.diff(total))], ["doc_id", "ids"]))
    pa.default_memory_pool().release_unused()
    return pa.concat_tables(out)


def _tokenizer(path: str):
    """The tokenizer, if its encoding can go word by word and its decoding piece by piece."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    parts = [tok.encode(w, add_special_tokens=False).ids for w in ("Ab c", "Ab", "c", "\t\x0b\x0c\r\n ")]
    if parts[0] != parts[1] + parts[2] or parts[3]:
        raise ValueError("the tokenizer keeps blanks: words cannot be encoded on their own")
    if json.loads(tok.to_str())["decoder"] is not None:
        raise ValueError("the tokenizer has a decoder of its own: pieces are not its text")
    return tok


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids (little-endian uint32) of every row's whole text, as the tokenizer file
    encodes it without added special tokens, truncation or padding.

    Null and empty texts have no ids. Rows are kept as they are: repeated rows repeat, null
    doc_ids stay null, other columns are ignored whatever their names, an empty table gives
    an empty result. A text longer than a block forms a block of its own; no text is cut.
    ``docs`` is read twice and must deal its rows to tasks alike both times, as files and
    written tables do; where it does not, the job fails rather than mix words up.
    """
    _tokenizer(tokenizer)
    texts = docs.select("doc_id", "text")
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    held = texts.mapInArrow(_hold(1 + total // BUCKET_BYTES), HELD)
    coded = held.groupBy("bucket").applyInArrow(_encode_words(tokenizer), CODED)
    return (texts.mapInArrow(_number, NUMBERED).groupBy("block").cogroup(coded.groupBy("block"))
            .applyInArrow(_place, "doc_id long, ids binary"))


def pieces(tokenizer: str) -> list[str]:
    """The id-to-piece table: text of every id, in order; '' where an id has none."""
    vocab = _tokenizer(tokenizer).get_vocab(with_added_tokens=True)
    out = [""] * (max(vocab.values(), default=-1) + 1)
    for token, n in vocab.items():
        out[n] = token
    if sum(map(len, out)) > PIECES_BYTES:
        raise ValueError("the id-to-piece table is too large to copy to tasks")
    return out


def _join_pieces(table: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = [f"{p} ".encode() if p else b"" for p in table]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        for batch in batches:
            col = batch.column("ids")
            counts = np.fromiter((0 if x is None else len(x) // 4 for x in col.to_pylist()), np.int64, len(col))
            for a, b in _spans(counts, CHUNK_IDS):
                ids = np.frombuffer(b"".join(x for x in col.slice(a, b - a).to_pylist() if x), "<u4").astype(np.int64)
                ids = np.where(ids < len(size), ids, len(size))    # no such piece: nothing is written
                width = np.append(size, 0)
                text = _gather(flat, width, ids).tobytes()
                stop = np.concatenate([[0], np.cumsum(counts[a:b])])
                ends = np.concatenate([[0], np.cumsum(width[ids])])[stop].tolist()
                texts = [text[x:max(x, y - 1)].decode() for x, y in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(texts, pa.string())],
                                                 [*batch.schema.names, "decoded"])
    return run


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids as ``encode`` gives them) with ``decoded``, the
    text that the tokenizer's decode(ids, skip_special_tokens=False) gives: the pieces with a
    blank between. Null and empty ids give an empty text; ids without a piece are left out;
    other columns are ignored."""
    return encoded.select("doc_id", "ids").mapInArrow(
        _join_pieces(pieces(tokenizer)), "doc_id long, ids binary, decoded string")


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256. Null
    and empty texts have 0 tokens and the hashes of nothing; rows are kept as ``encode`` says."""
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    both = decode(encode(tables.read(spark, sf_dir, "documents"), path), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
