"""Token-id files in Simple-8b word-aligned coding.

Format. A folder of Parquet parts; a row is one document, rows ascend by doc_id within a
part and parts ascend by their number: ``part``, ``start`` (ids of the part before the row), ``doc_id``, ``n_tokens``,
``offsets`` (little-endian uint32 pairs per block of ``BLOCK`` ids: 64-bit words up to the
end of the block, and packed words among them) and ``words`` (little-endian uint64).
A packed word has a selector in its top four bits and as many ids of equal width as the
selector says below, first id lowest. Selector 15 escapes an id above 60 bits: the id
itself follows as a whole word after the block's packed words, in order. Blocks are coded
on their own, so decoding is vectorised over all blocks and any block can be read alone.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tables, words

BLOCK = 128
# Ids per word for selectors 0..13; the width is 60 bits over the count.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
ESCAPE = 15
BLOCK_BYTES = 16 << 20  # texts that share a dictionary of words
CHUNK_IDS = 1 << 20    # ids coded or decoded at once

FILE = "part int, start long, doc_id long, n_tokens long, offsets binary, words binary"


def _selectors(bits: np.ndarray) -> np.ndarray:
    """Best selector at every place of every block. bits: (blocks, BLOCK + 60) bit lengths,
    0 beyond a block's end, so the last word may be part filled."""
    best = np.full((len(bits), BLOCK), 13, np.uint8)
    best[bits[:, :BLOCK] > 60] = ESCAPE
    top = bits[:, :BLOCK].copy()
    done = 1
    for s in range(12, -1, -1):          # counts 2, 3, 4, ... 60
        n = int(COUNTS[s])
        for j in range(done, n):
            np.maximum(top, bits[:, j:j + BLOCK], out=top)
        done = n
        fits = top <= WIDTHS[s]
        if n > 8 and not fits.any():
            break
        best[fits] = s
    return best


_BITS = np.array([n.bit_length() for n in range(1 << 16)], np.uint8)


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    if len(ids) and ids.max() >> np.uint64(16):
        high = ids >> np.uint64(16)
        return np.where(high > 0, 16 + _bit_lengths(high), _BITS[ids & np.uint64(0xFFFF)]).astype(np.uint8)
    return _BITS[ids.astype(np.int64)]


def encode(ids: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """(offsets, words) of each of the consecutive lists of uint64 ids."""
    blocks = -(-counts // BLOCK)
    owner = np.repeat(np.arange(len(counts)), blocks)
    inside = np.arange(len(owner)) - (np.cumsum(blocks) - blocks)[owner]
    first = (np.cumsum(counts) - counts)[owner] + inside * BLOCK
    size = np.minimum(counts[owner] - inside * BLOCK, BLOCK)
    grid = np.zeros((len(owner), BLOCK + 60), np.uint64)
    row = np.repeat(np.arange(len(owner)), size)
    col = np.arange(len(row)) - (np.cumsum(size) - size)[row]
    flat = ids[first[row] + col]
    grid[row, col] = flat
    bits = np.zeros(grid.shape, np.uint8)
    bits[row, col] = _bit_lengths(flat)
    pick = _selectors(bits)
    out = np.zeros((len(owner), 2 * BLOCK), np.uint64)
    packed = np.zeros(len(owner), np.int64)
    at = np.zeros(len(owner), np.int64)
    live = np.flatnonzero(size > 0)
    step = 0
    while len(live):
        sel = pick[live, at[live]]
        for s in np.unique(sel):
            rows = live[sel == s]
            if s == ESCAPE:
                out[rows, step] = np.uint64(ESCAPE) << np.uint64(60)
                at[rows] += 1
                continue
            n, width = int(COUNTS[s]), int(WIDTHS[s])
            word = np.full(len(rows), np.uint64(s) << np.uint64(60), np.uint64)
            for j in range(n):
                word |= grid[rows, at[rows] + j] << np.uint64(j * width)
            out[rows, step] = word
            at[rows] += n
        packed[live] += 1
        step += 1
        live = live[at[live] < size[live]]
    total = packed.copy()
    escaped = bits[:, :BLOCK] > 60
    if escaped.any():
        r, c = np.nonzero(escaped)
        nth = np.arange(len(r)) - np.searchsorted(r, r)
        out[r, packed[r] + nth] = grid[r, c]
        total += escaped.sum(1)
    flat = out[np.arange(2 * BLOCK) < total[:, None]].astype("<u8").tobytes()
    ends = np.cumsum(total)
    last = np.cumsum(blocks)
    stop = np.where(last > 0, ends[np.maximum(last - 1, 0)], 0) if len(ends) else np.zeros(len(counts), np.int64)
    begin = np.concatenate([[0], stop[:-1]]).astype(np.int64)
    pairs = np.stack([ends - begin[owner], packed], 1).astype("<u4")
    return ([pairs[a - n:a].tobytes() for a, n in zip(last, blocks)],
            [flat[8 * a:8 * b] for a, b in zip(begin, stop)])


def decode(offsets: list[bytes], coded: list[bytes], counts: np.ndarray) -> np.ndarray:
    """All ids of the given documents, in order, as uint64."""
    blocks = -(-counts // BLOCK)
    owner = np.repeat(np.arange(len(counts)), blocks)
    inside = np.arange(len(owner)) - (np.cumsum(blocks) - blocks)[owner]
    size = np.minimum(counts[owner] - inside * BLOCK, BLOCK)
    pairs = np.frombuffer(b"".join(offsets), "<u4").reshape(-1, 2).astype(np.int64)
    flat = np.frombuffer(b"".join(coded), "<u8").astype(np.uint64)
    base = np.cumsum([0] + [len(c) // 8 for c in coded[:-1]]) if coded else np.zeros(0, np.int64)
    ends = pairs[:, 0] + base[owner]
    starts = np.where(inside > 0, np.concatenate([[0], ends[:-1]]) if len(ends) else ends, base[owner])
    packed = pairs[:, 1]
    block = np.repeat(np.arange(len(packed)), packed)
    where = starts[block] + np.arange(len(block)) - (np.cumsum(packed) - packed)[block]
    word = flat[where]
    sel = (word >> np.uint64(60)).astype(np.int64)
    held = np.append(COUNTS, [0, 1])[sel]
    place = np.cumsum(held) - held
    lead = np.concatenate([[0], np.cumsum(packed)[:-1]]).astype(np.int64) if len(packed) else packed
    place -= place[np.minimum(lead, max(0, len(place) - 1))][block] if len(place) else 0
    out_first = np.cumsum(size) - size
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        if s == ESCAPE:
            b = block[mine]
            nth = np.arange(len(mine)) - np.searchsorted(b, b)
            out[out_first[b] + place[mine]] = flat[starts[b] + packed[b] + nth]
            continue
        n, width = int(COUNTS[s]), int(WIDTHS[s])
        mask = np.uint64((1 << width) - 1)
        room, target = size[block[mine]], out_first[block[mine]]
        for j in range(n):
            ok = place[mine] + j < room
            out[(target + place[mine] + j)[ok]] = (word[mine[ok]] >> np.uint64(j * width)) & mask
    return out


def _spans(counts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs of documents of about ``limit`` ids."""
    a, total = 0, np.cumsum(counts)
    while a < len(counts):
        done = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, done + limit, "right")))
        yield a, b
        a = b


# Byte-level models write a byte as the character of its own number if that is
# printable in Latin-1 (no blank, no soft hyphen), otherwise as the next one from 256 on.
_PRINTED = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
_BYTES = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_CHARS = "".join(" " if b == 32 else _BYTES.get(b, chr(b)) for b in range(256))
# Lower-case Latin letters, then marks: two pieces for tokenizers that split words from punctuation.
_PLAIN = r"^(?P<letters>[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]+)(?P<marks>[!-&(-/:;=?@\[\]^{}~]*)$"
_JOINED = 2000         # pieces encoded as one text
KEPT = 500_000         # pieces that a worker remembers


def _ragged(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((x for ids in lists for x in ids), np.uint32, int(size.sum())), size


def _gather(flat: np.ndarray, size: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The chosen lists of a ragged array, one after the other."""
    n = size[pick]
    shift = (np.cumsum(size) - size)[pick] - (np.cumsum(n) - n)
    return flat[np.repeat(shift, n) + np.arange(int(n.sum()))]


# The split rule under which a run of letters and the marks behind it are two pieces.
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_HARMLESS = ({"type": "NFC"}, {"type": "Lowercase"},
             {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "})


def _two_pieces(rules: dict) -> bool:
    """Whether a tokenizer's own description says that plain words (``_PLAIN``) are encoded
    piece by piece in their byte characters, with nothing before or after."""
    def steps(part: dict | None, inner: str) -> list[dict]:
        return [] if part is None else part[inner] if part["type"] == "Sequence" else [part]

    cuts = steps(rules["pre_tokenizer"], "pretokenizers")
    return (rules["model"]["type"] == "BPE" and bool(rules["model"].get("end_of_word_suffix"))
            and rules["post_processor"] is None
            and all(n in _HARMLESS for n in steps(rules["normalizer"], "normalizers"))
            and len(cuts) == 2 and cuts[0].get("pattern") == {"Regex": _RULE} and cuts[0].get("invert") is True
            and cuts[0].get("behavior") == "Removed" and cuts[1]["type"] == "ByteLevel"
            and not cuts[1].get("use_regex", True) and not cuts[1].get("add_prefix_space", True))


class _Pieces:
    """Ids of pieces met before by this worker, ``KEPT`` pieces at most."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self.flat, self.size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

    def __call__(self, known: list[str], encode_) -> tuple[np.ndarray, np.ndarray] | None:
        new = [p for p in known if p not in self.at]
        if len(self.at) + len(new) > KEPT:
            self.__init__()
            new = known
        found = encode_(new)
        if found is None:
            return None
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        self.flat, self.size = ([np.concatenate([*x, y])] for x, y in zip((self.flat, self.size), found))
        pick = np.fromiter(map(self.at.__getitem__, known), np.int64, len(known))
        return _gather(self.flat[0], self.size[0], pick), self.size[0][pick]


class _Encoder:
    """Ids of distinct words. Where the tokenizer's description allows it (``_two_pieces``),
    words of plain letters and marks go piece by piece straight to the tokenizer's model, many
    pieces joined by blanks at a time and told apart by the model's end-of-word tokens; all
    other words, and all words of other tokenizers, take the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        rules = json.loads(self.tok.to_str())
        same = self.tok.encode_batch_fast(["Abc XYZ", "abc xyz"], add_special_tokens=False)
        self.lowers = same[0].ids == same[1].ids
        self.ends, self.kept = None, _Pieces()
        if _two_pieces(rules):
            self.bare = Tokenizer(self.tok.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocab = self.tok.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[n for token, n in vocab.items() if token.endswith(rules["model"]["end_of_word_suffix"])]] = True

    def whole(self, words_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for a in range(0, len(words_), 20_000):
            out += [e.ids for e in self.tok.encode_batch_fast(words_[a:a + 20_000], add_special_tokens=False)]
        return _ragged(out)

    def pieces(self, known: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of pieces without blanks; None if their ends cannot be told."""
        texts = [" ".join(known[a:a + _JOINED]) for a in range(0, len(known), _JOINED)]
        texts = [t if t.isascii() else t.encode().decode("latin-1").translate(_CHARS) for t in texts]
        flat = [np.array(e.ids, np.uint32) for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        stop = np.flatnonzero(self.ends[flat]) + 1
        if len(stop) != len(known) or len(flat) != (stop[-1] if len(stop) else 0):
            return None
        return flat, np.diff(stop, prepend=0)

    def _split(self, parts: pa.StructArray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of plain words from their letters and marks."""
        letters, marks = (parts.field(n).dictionary_encode() for n in ("letters", "marks"))
        found = self.kept(letters.dictionary.to_pylist(), self.pieces)
        signs = marks.dictionary.to_pylist()
        ended = self.pieces([m for m in signs if m])
        if found is None or ended is None:
            return None
        size = np.zeros(len(signs), np.int64)
        size[[bool(m) for m in signs]] = ended[1]
        pick = np.stack([letters.indices.to_numpy(), len(found[1]) + marks.indices.to_numpy()], 1).astype(np.int64)
        both = np.concatenate([found[1], size])
        return _gather(np.concatenate([found[0], ended[0]]), both, pick.ravel()), both[pick].sum(1)

    def __call__(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per word)."""
        if self.ends is None or not len(vocab):
            return self.whole(vocab.to_pylist())
        parts = pc.extract_regex(vocab, _PLAIN)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        found = self._split(parts.filter(pa.array(plain)))
        if found is None:
            return self.whole(vocab.to_pylist())
        rest = self.whole(vocab.filter(pa.array(~plain)).to_pylist())
        at = np.empty(len(plain), np.int64)
        at[plain], at[~plain] = np.arange(plain.sum()), plain.sum() + np.arange((~plain).sum())
        size = np.concatenate([found[1], rest[1]])
        return _gather(np.concatenate([found[0], rest[0]]), size, at), size[at]


_ENCODERS: dict[str, _Encoder] = {}     # of this worker process, by tokenizer file


def _encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def _block_words(text: pa.Array, lowers: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(numbers of all words in order, words per text, the block's distinct words). Words are
    runs without the six ASCII blanks; null counts as empty. Where the tokenizer lower-cases
    itself, A-Z are lower-cased up front (fewer distinct words), but not in texts that may
    spell special tokens."""
    text = pc.fill_null(text, "")
    if lowers:
        text = pc.if_else(pc.match_substring(text, "<"), text, pc.ascii_lower(text))
    runs = pc.ascii_split_whitespace(text)
    coded = runs.flatten().dictionary_encode()
    ids, vocab = coded.indices.to_numpy(), coded.dictionary
    n = pc.list_value_length(runs).to_numpy()
    empty = pc.index(vocab, "").as_py()     # before or after a text's outer blanks
    if empty >= 0:
        full = ids != empty
        done = np.concatenate([[0], np.cumsum(full)])
        stop = np.cumsum(n)
        n, ids = done[stop] - done[stop - n], ids[full]
    return ids, n.astype(np.int64), vocab


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(path)
        for block in words.text_blocks(batches, BLOCK_BYTES):
            ids, n_words, vocab = _block_words(block.column("text").combine_chunks(), encoder.lowers)
            flat, size = encoder(vocab)
            stop = np.cumsum(n_words)
            doc_ids = block.column("doc_id").combine_chunks().cast(pa.int64())
            for a, b in _spans(n_words + 1, CHUNK_IDS // 2):
                w = ids[stop[a] - n_words[a]:stop[b - 1]]
                doc = np.repeat(np.arange(b - a), n_words[a:b])
                counts = np.bincount(doc, size[w], b - a).astype(np.int64) + 1
                out = np.full(int(counts.sum()), end_id, np.uint64)
                inner = np.ones(len(out), bool)
                inner[np.cumsum(counts) - 1] = False
                out[inner] = _gather(flat, size, w)
                offsets, coded = encode(out, counts)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(a, b - a), pa.array(counts), pa.array(offsets, pa.binary()),
                     pa.array(coded, pa.binary())], ["doc_id", "n_tokens", "offsets", "words"])
    return run


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each row begins within its part; rows come sorted by part."""
    part, done = None, 0
    for batch in batches:
        n = batch.column("n_tokens").to_numpy()
        parts = batch.column("part").to_numpy()
        total = np.cumsum(n) - n
        first = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(parts) else []
        start = np.empty(len(n), np.int64)
        for a, b in zip(first, [*first[1:], len(parts)]):
            if parts[a] != part:
                part, done = parts[a], 0
            start[a:b] = done + total[a:b] - total[a]
            done += int(n[a:b].sum())
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(start), *batch.columns[1:]],
                                         ["part", "start", *batch.schema.names[1:]])


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, name: str = "tokens") -> DataFrame:
    """Tokenize the whole texts (null: empty) with the tokenizer file, append ``end_id`` to
    each document, write the files described above and return them as read back.

    Words between ASCII blanks are encoded once per block, which is exact for tokenizers
    that never join text across blanks. Parts are ranges of doc_id between quantiles of the
    id column (a scan of that column alone). Null ids come first; repeated ids stay in the
    order of their coded words. Other columns are ignored; an empty table gives empty files."""
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = sorted({int(q) for q in ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n)})
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>")
    coded = docs.select("doc_id", "text").mapInArrow(
        _tokenize(tokenizer, end_id), "doc_id long, n_tokens long, offsets binary, words binary")
    part = F.coalesce(F.size(F.filter(bounds, lambda q: q <= F.col("doc_id"))) + 1, F.lit(0))
    placed = (coded.select(F.when(F.col("doc_id").isNull(), 0).otherwise(part).alias("part"), "*")
              .repartition("part").sortWithinPartitions("part", "doc_id", "words").mapInArrow(_place, FILE))
    return tables.scratch(placed, name)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = batch.column("n_tokens").to_numpy()
        offsets, coded = batch.column("offsets").to_pylist(), batch.column("words").to_pylist()
        for a, b in _spans(counts, CHUNK_IDS):
            raw = decode(offsets[a:b], coded[a:b], counts[a:b]).astype("<u4").tobytes()
            ends = np.cumsum(counts[a:b]) * 4
            ids = [raw[e - 4 * n:e] for e, n in zip(ends.tolist(), counts[a:b].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part").slice(a, b - a), batch.column("start").slice(a, b - a),
                 batch.column("doc_id").slice(a, b - a), pa.array(ids, pa.binary())],
                ["part", "start", "doc_id", "ids"])


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (uint32 little-endian) of
    every document in ``files``."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    ids = files.mapInArrow(_decoded, "part int, start long, doc_id long, ids binary")
    # one row per file part: as many as the writer had partitions, whatever the input
    return ids.join(F.broadcast(parts), "part").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "ids")


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    files = write_tokens(tables.read(spark, sf_dir, "documents"),
                         public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_tokens(files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
