"""MinHash near-duplicates by a signature-coordinate inverted join.

1. Every text becomes its set of ``k``-word shingles and a signature of ``COORDS`` minima;
   texts with the same set form one class, represented by the text of the smallest id (null
   last). A class's key is that id followed by eight bytes of the set's digest, so keys sort
   by id, and an id that names several texts, or none, still tells classes apart.
2. Each class is posted under its (coordinate, value) pairs. Pairs that only one class
   holds cannot collide and go; a class with fewer than ``MATCH`` left has no partner.
3. Prefix: with each class's postings ordered by (frequency, key), two classes that agree
   in ``MATCH`` coordinates share one of the first ``c - MATCH + 1``; only those are kept.
4. Merging: lists of up to ``SMALL`` classes are merged in place, counting collisions over
   the whole signatures; pairs at ``MATCH`` or more are kept. Longer lists (families of
   near copies) are skipped over pairwise and tie their members to the list's first class.
   Both give candidate families (connected components).
5. Every family is checked on the full sets, in pairs of blocks of about ``BLOCK`` classes;
   each block pair returns a spanning forest of its links, never all pairs.

At similarity 0.8 the number of equal coordinates is Binomial(40, 0.8): a pair is missed
(fewer than 20) with probability 5e-6; everything after the candidate step is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tables, words

COORDS = 40
MATCH = 20
SMALL = 32
BLOCK = 128

SIGNED = "doc_id long, text_key long, n_shingles long, set_id binary, sig array<int>"
LAST = 2**63 - 1                 # stands for a null id: any id is smaller
LINKS = "a binary, b binary"


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240)
    mult = rng.integers(0, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return mult, rng.integers(0, 1 << 63, COORDS, dtype=np.uint64)


def _sets(block: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    ids, counts, known = words.block_words(words.as_bytes(block.column("text")))
    return words.shingles(ids, counts, words.hash_words(known), k)


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult, add = _coefficients()
        for block in words.text_blocks(batches):
            sh, n = _sets(block, k)
            ends = np.cumsum(n)
            full = n > 0
            starts = (ends - n)[full]
            sig = np.zeros((int(full.sum()), COORDS), np.uint32)
            for j in range(COORDS):
                if len(starts):
                    low = np.minimum.reduceat(sh * mult[j] + add[j], starts)
                    sig[:, j] = (low >> np.uint64(32)).astype(np.uint32)
            raw = sh.tobytes()
            ids = [xxhash.xxh3_128_digest(raw[8 * (e - m):8 * e]) if m else None
                   for e, m in zip(ends.tolist(), n.tolist())]
            offsets = np.concatenate([[0], np.cumsum(full * COORDS)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id").combine_chunks().cast(pa.int64()),
                block.column("text_key").combine_chunks(), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.reshape(-1).view(np.int32))),
            ], ["doc_id", "text_key", "n_shingles", "set_id", "sig"])
    return run


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """Set and signature of every row; ``text_key`` is a hash of the text as it stands."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(_sign(k), SIGNED)


def _forest(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    left = np.ones(len(linked), bool)
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        stack = [root]
        while stack:
            a = stack.pop()
            new = np.flatnonzero(linked[a] & left)
            left[new] = False
            for b in new.tolist():
                yield a, b
            stack.extend(new.tolist())


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.binary()),
                                       pa.array([x[1] for x in found], pa.binary())], ["a", "b"])


def _merge_lists(match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            col = batch.column("members")
            offsets = col.offsets.to_numpy()
            flat = col.values
            reps = flat.field("rep").to_pylist()
            sigs = flat.field("sig").values.to_numpy().reshape(-1, COORDS)
            for a, b in zip(offsets[:-1], offsets[1:]):
                s = sigs[a:b]
                same = (s[:, None, :] == s[None, :, :]).sum(2) >= match
                found += [(reps[a + i], reps[a + j]) for i, j in _forest(same)]
            yield _edges(found)
    return run


def _links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """100 * intersection >= percent * union for all pairs of the given sets."""
    n = len(sets)
    size = np.fromiter(map(len, sets), np.int64, n)
    both = np.zeros((n, n), np.int64)
    if n <= 6:
        for i in range(n):
            for j in range(i):
                both[i, j] = both[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        value, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), size)
        column = np.cumsum(count > 1) - 1
        use = count[at] > 1
        at, owner = column[at[use]], owner[use]
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        for lo in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
            a, b = np.searchsorted(at, [lo, lo + 4096])
            x = np.zeros((n, 4096), np.float32)
            x[owner[a:b], at[a:b] - lo] = 1
            both += (x @ x.T).astype(np.int64)
    union = size[:, None] + size[None, :] - both
    linked = 100 * both >= percent * union
    np.fill_diagonal(linked, False)
    return linked


def _check_families(percent: int):
    def close(key, reps, sets):
        return [(reps[i], reps[j]) for i, j in _forest(_links(sets, percent))] if len(reps) > 1 else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reps, sets = None, [], []
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            for u, i, j, rep, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if (u, i, j) != key:
                    found += close(key, reps, sets)
                    key, reps, sets = (u, i, j), [], []
                reps.append(rep)
                sets.append(np.frombuffer(shingles, np.uint64))
            yield _edges(found)
        yield _edges(close(key, reps, sets))
    return run


def _texts_to_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.text_blocks(batches):
            sh, n = _sets(block, k)
            raw, ends = sh.tobytes(), np.cumsum(n)
            parts = [raw[8 * (e - m):8 * e] for e, m in zip(ends.tolist(), n.tolist())]
            same = [xxhash.xxh3_128_digest(p) == s for p, s in
                    zip(parts, block.column("set_id").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [block.column("unit").combine_chunks(), block.column("rep").combine_chunks(),
                 pa.array(parts, pa.binary())], ["unit", "rep", "shingles"]
            ).filter(pa.array(same, pa.bool_()))
    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, text_key,
    first.

    Links: 100 * intersection >= ``percent`` * union of distinct ``k``-word shingle sets;
    component_id is the smallest doc_id reachable. Texts without words (null, empty) have
    set size 0 and link with nothing. Repeated rows share a class; a doc_id with several texts
    is linked through each of them. A row whose doc_id is null links, and joins others, like
    any other, but a component takes its name from the ids that are there: one of null ids only
    has component_id null. kept = (doc_id = component_id). ``first`` marks one text of each
    component, that of the smallest id (of several texts of that id the one with the smallest
    digest), and every text without words; rows that repeat it are marked as well. ``text_key``
    is a 64-bit hash of the text as it stands. Other columns are ignored; an empty table gives
    an empty result. Texts of any length are taken whole.
    """
    signed = tables.scratch(signatures(docs, k), "signatures")
    known = F.coalesce("doc_id", F.lit(LAST))
    key = F.concat(F.unhex(F.lpad(F.hex(F.col("m.id").bitwiseXOR(F.lit(-2**63))), 16, "0")),
                   F.substring("set_id", 1, 8))
    classes = (signed.filter("set_id IS NOT NULL").groupBy("set_id")
               .agg(F.min(F.struct(known.alias("id"), "text_key", "sig")).alias("m"))
               .select("set_id", key.alias("rep"), "m.id", "m.text_key", "m.sig"))
    classes = tables.scratch(classes, "classes")

    posted = (classes.select("rep", F.posexplode("sig").alias("at", "value"))
              .select("rep", F.expr("shiftleft(cast(at as long), 32) | (value & 4294967295L)").alias("key")))
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = Window.partitionBy("rep")
    prefix = (posted.join(shared.hint("shuffle_hash"), "key")
              .withColumn("c", F.count(F.lit(1)).over(own)).filter(F.col("c") >= MATCH)
              .withColumn("rn", F.row_number().over(own.orderBy("df", "key")))
              .filter(F.col("rn") <= F.col("c") - (MATCH - 1)).select("rep", "key", "df"))
    prefix = tables.scratch(prefix, "prefix")

    small = (prefix.filter(F.col("df") <= SMALL).join(classes.select("rep", "sig"), "rep")
             .groupBy("key").agg(F.collect_list(F.struct("rep", "sig")).alias("members"))
             .filter(F.size("members") > 1).select("members")
             .mapInArrow(_merge_lists(MATCH), LINKS))
    large = prefix.filter(F.col("df") > SMALL).select("rep", "key")
    head = large.groupBy("key").agg(F.min("rep").alias("a"))
    tied = large.join(head, "key").select("a", F.col("rep").alias("b")).distinct()
    # one edge from each member to the smallest first class of its lists, and one from every
    # other first class of those lists to that one: as connected, with far fewer edges
    least = tied.groupBy("b").agg(F.min("a").alias("m"))
    tied = tied.join(least, "b").select("a", F.col("m").alias("b")).distinct().union(least.select("m", "b"))
    units = tables.components(small.union(tied))

    links = tables.scratch(_verify(docs, classes, units, k, percent), "links")
    label = tables.components(links)
    # keys sort by id: a component's label is the key of its first class
    unit = F.coalesce("label", "rep")
    lead = F.conv(F.hex(F.substring(unit, 1, 8)), 16, 10).cast("decimal(20,0)") - F.expr("cast(9223372036854775808 AS decimal(20, 0))")
    named = (classes.select("set_id", "rep", F.col("text_key").alias("lead_text"))
             .join(label.select(F.col("node").alias("rep"), "label"), "rep", "left")
             .select("set_id", (unit == F.col("rep")).alias("leads"), "lead_text",
                     F.nullif(lead.cast("long"), F.lit(LAST)).alias("component")))
    out = signed.select("doc_id", "text_key", "n_shingles", "set_id").join(named, "set_id", "left")
    component = F.when(F.col("leads").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    leads = F.col("leads") & (F.col("text_key") == F.col("lead_text")) & F.col("doc_id").eqNullSafe(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "text_key",
                      F.coalesce(leads, F.lit(True)).alias("first"))


def _verify(docs: DataFrame, classes: DataFrame, units: DataFrame, k: int, percent: int) -> DataFrame:
    """Exact links within the candidate families, as spanning forests of block pairs."""
    members = (units.select(F.col("node").alias("rep"), F.col("label").alias("unit"))
               .join(classes.select("rep", "set_id", "id", F.col("text_key").alias("wanted")), "rep"))
    texts = (docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("at"), F.xxhash64("text").alias("text_key"), "text")
             .join(members.hint("shuffle_hash"), (F.col("at") == F.col("id")) & (F.col("text_key") == F.col("wanted")))
             .select("unit", "rep", "set_id", "text"))
    sets = tables.scratch(texts.mapInArrow(_texts_to_sets(k), "unit binary, rep binary, shingles binary"), "sets")
    blocks = (sets.groupBy("unit").agg(F.count_distinct("rep").alias("n"))
              .select("unit", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb")))
    placed = (sets.dropDuplicates(["rep"]).join(blocks, "unit")
              .withColumn("at", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
              .withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
              .select("unit", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
                      "rep", "shingles"))
    return (placed.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")
            .mapInArrow(_check_families(percent), LINKS))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents`` at four words and 0.8; nulls, empty and long texts, ties
    and repeated rows as ``near_duplicates`` says. Returns doc_id, n_shingles, component_id, kept."""
    found = near_duplicates(tables.read(spark, sf_dir, "documents"), k=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
