"""Prefix trie of conversations through ROLLUP over positional turn-id columns.

1. A turn's id is the digest of its role and text, with its number of words behind it.
   Conversations are rebuilt from ids alone and laid out in blocks of ``WIDTH`` columns
   t1..tWIDTH, one row per conversation and block.
2. ``node``, the node at which the block before ended, is a digest carried along each
   conversation's blocks, row by row.
3. Down: one ``GROUP BY node, ROLLUP(t1, ..)`` over the blocks of all depths counts the members
   of all prefixes; grouping_id tells a prefix's length.
4. Nodes meet their parents and children by path digest.
5. Up: sums of blocks go to the nodes above them by pointer doubling over the tops of blocks
   (log2 of the number of blocks rounds); a second ROLLUP over the same columns adds them to
   the leaves and saved tokens of every subtree of a block.

The number of jobs grows with the logarithm of the longest conversation, plans do not grow.
Every step is a partial aggregation before its shuffle, so a first turn, or a whole
conversation, that a third of all rows share costs one row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tables

WIDTH = 16            # turn columns in a block
CHUNK = 1 << 16       # bytes of joined ids in one piece of a list
ROOT = "unhex('00')"  # path of the node without turns
WORD = r"[^\x20\x09-\x0D]+"

_COLUMNS = [f"t{i}" for i in range(1, WIDTH + 1)]
# every grouping set's level, from the columns that it leaves out
_LEVEL = f"{WIDTH} - bit_count(grouping_id())"
# prefixes that are there: their last column is a turn
_THERE = " OR ".join(f"(grouping_id() = {2 ** (WIDTH - j) - 1} AND t{j} IS NOT NULL)" for j in range(1, WIDTH + 1))
_ROOT = f"(grouping_id() = {2 ** WIDTH - 1} AND node = {ROOT})"


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id): 16 bytes of digest of role and text (null: empty), then the number of
    words of the text in 4 bytes. Rows without conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    words = F.unhex(F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 8, "0"))
    return (conversations.filter("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.concat(digest, words).alias("id")))


def rebuilt(conversations: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """((conv_id, n turns) of all conversations, (conv_id, at, id) of their turns, at from 0).

    Conversation c takes the first h turns of conversation c - c % group (the remainder has
    the sign of c, as in SQL), h = crc32(c) % heads, then its own turns after its first h."""
    own = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    turns = tables.scratch(turn_ids(conversations).withColumn("at", F.row_number().over(own) - 1), "turns")
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    convs = (turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
             .select("conv_id", "own", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base")))
    # at most heads - 1 turns of every group's first conversation, for at most 2 * group - 1 others
    first = (turns.filter((F.col("conv_id") % group == 0) & (F.col("at") < heads - 1))
             .select(F.col("conv_id").alias("base"), "at", "id"))
    known = first.groupBy("base").agg(F.count(F.lit(1)).alias("known"))
    convs = tables.scratch(
        convs.join(known, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("known", F.lit(0))).cast("int"))
        .select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")),
        "convs")
    head = (convs.filter("taken > 0").join(first, "base").filter(F.col("at") < F.col("taken"))
            .select("conv_id", "at", "id"))
    rest = (turns.join(convs, "conv_id").filter(F.col("at") >= F.col("h"))
            .select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "id"))
    return convs.select("conv_id", "n"), head.unionByName(rest)


def _digest(upto: str) -> str:
    """Path of the prefix of a row's first ``upto`` turns below ``node``."""
    turns = ", ".join(f"CASE WHEN {upto} >= {j} THEN t{j} ELSE unhex('') END" for j in range(1, WIDTH + 1))
    return f"CASE WHEN {upto} = 0 THEN node ELSE unhex(md5(concat(node, {turns}))) END"


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, block) with the turns of a full block in ``turns`` -> the same
    rows with ``node`` in its place: the path of all blocks before."""
    root = node = b"\0"
    for rows in batches:
        nodes = []
        for block, turns in zip(rows.column("block").to_pylist(), rows.column("turns").to_pylist()):
            nodes.append(node := node if block else root)
            if turns is not None:
                node = hashlib.md5(node + turns).digest()
        at = rows.schema.get_field_index("turns")
        yield rows.set_column(at, "node", pa.array(nodes, pa.binary()))


def _blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Turns laid out (conv_id, n, block, t1.., node), written."""
    place = F.col("at") % WIDTH
    wide = (turns.groupBy("conv_id", F.floor(F.col("at") / WIDTH).cast("int").alias("block"))
            .agg(*[F.max(F.when(place == i, F.col("id"))).alias(f"t{i + 1}") for i in range(WIDTH)]))
    rows = (convs.join(wide, "conv_id", "left")
            .select("conv_id", "n", F.coalesce("block", F.lit(0)).alias("block"), *_COLUMNS, F.concat(*_COLUMNS).alias("turns")))
    schema = "conv_id long, n long, block int, " + ", ".join(f"{t} binary" for t in _COLUMNS) + ", node binary"
    return tables.scratch(rows.repartition("conv_id").sortWithinPartitions("conv_id", "block")
                          .mapInArrow(_carry, schema), "blocks")


def _down(rows: DataFrame, block: int | str) -> DataFrame:
    """Nodes of blocks: members, smallest member, path and parent's path. ``block``: the rows'
    block number, or the column with it."""
    found = rows.sparkSession.sql(
        f"SELECT node, {', '.join(_COLUMNS)}, {_LEVEL} AS level, count(*) AS n_convs, min(conv_id) AS conv_id, "
        f"min({block}) AS block FROM {{rows}} GROUP BY node, ROLLUP({', '.join(_COLUMNS)}) HAVING {_THERE} OR {_ROOT}", rows=rows)
    return found.select(
        "node", *_COLUMNS, "level", "n_convs", "conv_id", (F.col("level") + F.col("block") * WIDTH).alias("depth"),
        F.expr(_digest("level")).alias("path"),
        F.when(F.col("level") > 0, F.expr(_digest("level - 1"))).alias("parent"))


def _below(nodes: DataFrame, deepest: int) -> DataFrame:
    """(under, under_leaves, under_saved): sums of all that is below the top of every block but
    the first ones. In each round a top has the sums of the tops less than 2^round blocks below
    it and knows the one 2^round blocks above it."""
    tops = (nodes.groupBy(F.col("node").alias("path")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
            .join(nodes.filter(F.col("level") == WIDTH).select("path", F.expr(f"nullif(node, {ROOT})").alias("up")), "path"))
    tops = tables.scratch(tops, "tops")
    for r in range(max(deepest - 1, 0).bit_length()):
        more = (tops.filter("up IS NOT NULL").groupBy(F.col("up").alias("path"))
                .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        further = tops.select(F.col("path").alias("up"), F.col("up").alias("further"))
        tops = tables.scratch(
            tops.join(more, "path", "left").join(further, "up", "left")
            .select("path", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), F.col("further").alias("up")),
            f"tops{r}")
    return tops.select(F.col("path").alias("under"), F.col("leaves").alias("under_leaves"), F.col("saved").alias("under_saved"))


def _up(nodes: DataFrame, below: DataFrame) -> DataFrame:
    """Every node with the sums of its subtree."""
    nodes = (nodes.join(below, F.col("path") == F.col("under"), "left")
             .withColumn("leaves", F.col("leaves") + F.coalesce("under_leaves", F.lit(0)))
             .withColumn("saved", F.col("saved") + F.coalesce("under_saved", F.lit(0))))
    return nodes.sparkSession.sql(
        f"SELECT node, {', '.join(_COLUMNS)}, sum(leaves) AS n_leaves, sum(saved) AS saved_tokens, "
        f"min(struct(level, conv_id, depth, parent_conv_id, n_convs, n_children, path)) AS own "
        f"FROM {{nodes}} GROUP BY node, ROLLUP({', '.join(_COLUMNS)}) HAVING {_THERE} OR {_ROOT}", nodes=nodes)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (path, conv_id) -> pieces of the comma-joined list of every path."""
    held: tuple[bytes, int, list[str], int] | None = None
    out: list[tuple[bytes, int, str]] = []

    def close() -> None:
        if held:
            out.append((held[0], held[1], ",".join(held[2])))

    def batch() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in
                                           zip(list(zip(*out)) or [[], [], []], (pa.binary(), pa.int64(), pa.string()))],
                                          ["path", "first", "ids"])
        out.clear()
        return done

    for rows in batches:
        for path, conv in zip(rows.column("path").to_pylist(), rows.column("conv_id").to_pylist()):
            text = str(conv)
            if held and held[0] == path and held[3] + len(text) < CHUNK:
                held[2].append(text)
                held = (path, held[1], held[2], held[3] + len(text) + 1)
            else:
                close()
                held = (path, conv, [text], len(text))
                if sum(len(x[2]) for x in out[-64:]) >= CHUNK:
                    yield batch()
        yield batch()
    close()
    yield batch()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (path, first) -> SHA-256 of every path's list, piece by piece."""
    path, running = None, None
    for rows in batches:
        out: list[tuple[bytes, str]] = []
        for at, ids in zip(rows.column("path").to_pylist(), rows.column("ids").to_pylist()):
            if at == path:
                running.update(b",")
            else:
                if running is not None:
                    out.append((path, running.hexdigest()))
                path, running = at, hashlib.sha256()
            running.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()),
                                          pa.array([x[1] for x in out], pa.string())], ["path", "sha"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([running.hexdigest()])], ["path", "sha"])


def list_hashes(ends: DataFrame) -> DataFrame:
    """(path, sha): SHA-256 of the ascending, comma-joined conv_ids of every path. The list of
    a path is cut into pieces where it lies, sorted over all tasks; then the pieces of a path
    are hashed in order, one at a time in memory."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (ends.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
              .mapInArrow(_pieces, "path binary, first long, ids string"))
    return (pieces.repartition("path").sortWithinPartitions("path", "first")
            .mapInArrow(_hashes, "path binary, sha string"))


def conversation_trie(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations (see ``rebuilt``).

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs, n_children,
    n_leaves and saved_tokens of the subtree, ends_sha256, path (16-byte digest of the turns,
    the node's key). Null turns sort first; rows of one conversation with equal turn are
    ordered by their ids (digests of role and text), so repeated rows count as turns of their
    own; null role and text are empty; rows without conv_id take no part; other columns are
    ignored. An empty table has no root and gives an empty result. The logarithm of
    the longest conversation's length sets the number of jobs. Turns are told apart by 128-bit digests.
    """
    convs, turns = rebuilt(conversations, group, heads)
    rows = _blocks(convs, turns)
    deepest = rows.agg(F.max("block")).first()[0] or 0
    nodes = tables.scratch(_down(rows, "block"), "down")
    ends = (rows.filter(F.col("n") <= (F.col("block") + 1) * WIDTH)
            .select("conv_id", F.expr(_digest(f"(n - block * {WIDTH})")).alias("path")))
    hashes = tables.scratch(list_hashes(tables.scratch(ends, "ends")), "hashes")

    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    children = tables.scratch(
        nodes.select("path", F.col("conv_id").alias("parent_conv_id")).join(children, "path"), "children")
    saved = (F.col("n_convs") - 1) * F.conv(F.hex(F.substring(F.element_at(F.array(*_COLUMNS), F.col("level")), 17, 4)), 16, 10).cast("long")
    known = (nodes.join(children.select("path", "n_children"), "path", "left")
             .join(children.select(F.col("path").alias("parent"), "parent_conv_id"), "parent", "left")
             .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
             .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
             .withColumn("saved", F.when(F.col("level") > 0, saved).otherwise(F.lit(0))))
    known = tables.scratch(known, "known")
    out = tables.scratch(_up(known, _below(known, deepest)).select("own.*", "n_leaves", "saved_tokens"), "up")
    nothing = hashlib.sha256(b"").hexdigest()
    out = out.join(hashes, "path", "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                      "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"), "path")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the whole table ``conversations``; nulls, ties, repeated rows and empty tables
    as in ``conversation_trie``."""
    return conversation_trie(tables.read(spark, sf_dir, "conversations")).drop("path")


# crc32 of a decimal number: the reflected polynomial, bit by bit.
OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS s,
         md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
  SELECT conv_id, list(s ORDER BY turn NULLS FIRST, d) AS own,
         xor(list_reduce([ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')], lambda crc, b:
           list_reduce([xor(crc, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, z:
             xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)),
           4294967295), 4294967295) % 4 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, coalesce(b.own[1:c.h], []) || c.own[c.h + 1:] AS path
  FROM lists c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT depth, path[1:depth] AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN len(path) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, path[1:depth]),
linked AS (
  SELECT n.*, m.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.p[1:n.depth] = n.p) AS n_children,
         CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * len(regexp_extract_all(n.p[n.depth].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN nodes m ON n.depth > 0 AND m.depth = n.depth - 1 AND m.p = n.p[1:n.depth - 1]),
sums AS (
  SELECT a.depth, a.p, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum(b.saved) AS saved_tokens
  FROM linked a JOIN linked b ON b.depth >= a.depth AND b.p[1:a.depth] = a.p GROUP BY a.depth, a.p)
SELECT l.conv_id, l.depth::BIGINT AS depth, l.parent_conv_id, l.n_convs::BIGINT AS n_convs, l.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l JOIN sums s ON s.depth = l.depth AND s.p = l.p
"""
