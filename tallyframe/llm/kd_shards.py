"""Sharding by a k-d tree over document metadata, with DataFrame operations only.

A node that still owes several shards is cut along its widest metadata dimension at the
weighted median: the place that splits its bytes in proportion to the shards owed on either
side. Rows have a total order along every dimension (coordinate, hash, id, checksum), and
the cut is found by three aggregations over the narrow table (coordinate, then hash within
the cutting coordinate, then rows within the cutting hash), so no node is ever sorted as a
whole. Only the cuts (one row per node) reach the driver, which keeps the tree as a CASE
expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tables

STEPS = 4096            # coordinates per dimension
HASHES = 65536          # places within one coordinate
SLOTS = 64              # parts in which the rows of a shard are numbered
OVERHEAD = 16           # bytes a row takes besides its text

DIMENSIONS = ("k_source", "k_lang", "k_size")


@dataclass
class Node:
    first: int          # first shard
    shards: int         # shards owed
    dim: str = ""
    cut: tuple = ()     # (coordinate, hash, id, checksum)
    inclusive: bool = True
    low: Node | None = None
    high: Node | None = None


def _below(node: Node) -> Column:
    """Whether a row belongs to the lower side of the cut (lexicographic comparison)."""
    names = (node.dim, "k_hash", "k_id", "text_crc32")
    last = F.col(names[-1]) <= node.cut[-1] if node.inclusive else F.col(names[-1]) < node.cut[-1]
    for name, at in list(zip(names, node.cut))[-2::-1]:
        last = (F.col(name) < at) | ((F.col(name) == at) & last)
    return last


def _place(node: Node, value) -> Column:
    """``value`` of the leaf a row falls in, as nested CASE expressions."""
    if node.low is None:
        return value(node)
    return F.when(_below(node), _place(node.low, value)).otherwise(_place(node.high, value))


def _leaves(node: Node) -> list[Node]:
    return [node] if node.low is None else _leaves(node.low) + _leaves(node.high)


def _by(nodes: list[Node], value) -> Column:
    """A column that depends on the node number in ``node`` (a lookup, not a CASE)."""
    at = {n.first: value(n) for n in nodes}
    return F.element_at(F.array(*(F.lit(at.get(i)) for i in range(max(at) + 1))), F.col("node") + 1)


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the coordinates of every row."""
    code = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(STEPS)).cast("int")
    at = {c: code(c) if c in docs.columns else F.lit(0) for c in ("source", "lang")}
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD
    narrow = docs.select("doc_id", size.alias("size"),
                         F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                         at["source"].alias("k_source"), at["lang"].alias("k_lang"))
    return narrow.select("*", F.least(F.lit(STEPS - 1), F.floor(F.log2("size") * 128)).cast("int").alias("k_size"),
                         F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(HASHES)).cast("int").alias("k_hash"),
                         F.coalesce("doc_id", F.lit(-(2**63))).alias("k_id"))


def _crossing(sums: DataFrame, order: list[str], goal: Column) -> list:
    """Per node the row at which the running sum of ``size`` reaches the goal."""
    run = Window.partitionBy("node").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (sums.withColumn("upto", F.sum("size").over(run)).withColumn("goal", goal)
            .filter("upto >= goal AND upto - size < goal").collect())


def _cut(rows: DataFrame, nodes: list[Node], totals: dict[int, int]) -> None:
    """Set dim, cut and children of all ``nodes`` (each holds rows and owes several shards)."""
    goal = {n.first: totals[n.first] * (n.shards // 2) / n.shards for n in nodes}
    dim = _by(nodes, lambda n: DIMENSIONS.index(n.dim) + 1)
    rows = tables.scratch(rows.select("node", "size", "k_hash", "k_id", "text_crc32",
                                      F.element_at(F.array(*DIMENSIONS), dim).alias("at")), "level")
    left = lambda: _by(nodes, lambda n: float(goal[n.first]))
    found = _crossing(rows.groupBy("node", "at").agg(F.sum("size").alias("size")), ["at"], left())
    coordinate = {r.node: r["at"] for r in found}
    for r in found:
        goal[r.node] -= r.upto - r["size"]
    rows = rows.filter(F.col("at") == _by(nodes, lambda n: coordinate[n.first]))
    found = _crossing(rows.groupBy("node", "k_hash").agg(F.sum("size").alias("size")), ["k_hash"], left())
    hashed = {r.node: r.k_hash for r in found}
    for r in found:
        goal[r.node] -= r.upto - r["size"]
    rows = rows.filter(F.col("k_hash") == _by(nodes, lambda n: hashed[n.first]))
    rows = rows.groupBy("node", "k_id", "text_crc32").agg(F.sum("size").alias("size"))
    for r in _crossing(rows, ["k_id", "text_crc32"], left()):
        node = next(n for n in nodes if n.first == r.node)
        node.cut = (coordinate[r.node], hashed[r.node], r.k_id, r.text_crc32)
        node.inclusive = r.upto - goal[r.node] <= goal[r.node] - (r.upto - r["size"])
        half = node.shards // 2
        node.low, node.high = Node(node.first, half), Node(node.first + half, node.shards - half)


def grow(rows: DataFrame, shards: int) -> Node:
    """The tree over ``metadata`` rows."""
    root = Node(0, shards)
    while True:
        todo = [n for n in _leaves(root) if n.shards > 1 and not n.dim]
        if not todo:
            return root
        placed = rows.withColumn("node", _place(root, lambda n: F.lit(n.first)))
        placed = placed.filter(F.col("node").isin(*(n.first for n in todo)))
        stats = placed.groupBy("node").agg(F.sum("size").alias("size"), *(
            (F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS)).collect()
        seen = {r.node: r for r in stats}
        for n in todo:
            n.dim = max(DIMENSIONS, key=lambda d: seen[n.first][d]) if n.first in seen else "empty"
        cut = [n for n in todo if n.dim != "empty"]
        if cut:
            _cut(placed, cut, {n.first: seen[n.first]["size"] for n in cut})


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Shards hold near-equal bytes (law ``bytes``): either ``shards`` of them, or as many as
    bring a shard to ``target_bytes``. size is the text's UTF-8 bytes (null: none) plus 16.
    slot numbers the rows of a shard from 0 without gaps. Rows that agree in id and text
    stay together; null ids sort first; missing ``source`` or ``lang`` columns count as
    constant and null values as one value. Other columns are ignored; an empty table gives
    an empty result.
    """
    rows = tables.scratch(metadata(docs), "metadata")
    if shards is None:
        total = rows.agg(F.sum("size").alias("s")).first().s or 0
        shards = max(1, -(-total // target_bytes))
    tree = grow(rows, shards)
    placed = (rows.withColumn("shard", _place(tree, lambda n: F.lit(n.first)).cast("int"))
              .withColumn("part", F.pmod(F.col("k_hash"), F.lit(SLOTS))))
    placed = tables.scratch(placed.select("doc_id", "size", "text_crc32", "shard", "part"), "placed")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    return (placed.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("at")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(tables.read(spark, sf_dir, "documents"), shards=40)
