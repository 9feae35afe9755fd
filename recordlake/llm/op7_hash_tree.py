"""Operator 7, sharding: a hierarchical weighted hash tree.

A row descends region, rack and shard levels. At each level every child draws
``-ln(u) / weight`` from a hash of (key, child path) and the smallest draw wins,
so a child gets rows in proportion to its weight, and a changed weight moves rows
only between the subtree that changed and its siblings. A new shard opens as a
region of its own (``grow``), the one change under which rows move into the new
shard and nowhere else: growing an existing rack would also let rows that newly
enter the rack fall into its old shards.

Defined cases: a null key is a key like any other (the string ``null``); equal
keys go to equal shards; a null text has size 1 and the checksum of no bytes; an
empty table gives no rows; other columns are ignored. Slots number a shard's rows
by (file, row), so they don't depend on partitioning; no task sees more than one
file chunk's rows of one shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.llm.common import anchored, col, positioned

#: Rows of a file whose slots one task numbers.
CHUNK_ROWS = 16_384


@dataclass(frozen=True)
class Node:
    """A subtree: ``shard`` for a leaf, else ``children``."""
    weight: float
    shard: int | None = None
    children: tuple["Node", ...] = ()


def tree(shards: int, per_rack: int = 4, racks: int = 2) -> Node:
    """Regions of ``racks`` racks of ``per_rack`` shards each, all shards of weight 1."""
    def over(nodes: list[Node], k: int) -> list[Node]:
        return [Node(sum(n.weight for n in nodes[i:i + k]), None, tuple(nodes[i:i + k]))
                for i in range(0, len(nodes), k)]
    if shards < 1:
        raise ValueError("at least one shard")
    return over(over(over([Node(1.0, s) for s in range(shards)], per_rack), racks), shards)[0]


def grow(root: Node, shard: int, weight: float = 1.0) -> Node:
    """One more shard, in a rack and region of its own."""
    leaf = Node(weight, shard)
    region = Node(weight, None, (Node(weight, None, (leaf,)),))
    return Node(root.weight + weight, None, (*root.children, region))


def levels(root: Node) -> list[dict[str, Node]]:
    """Nodes of each level below the root by their path of child numbers; a leaf above the
    deepest level is its own only child there, so that all paths end at one depth."""
    out, here = [], {"": root if root.children else Node(root.weight, None, (root,))}
    while any(n.children for n in here.values()):
        here = {f"{path}/{i}": c for path, n in here.items() for i, c in enumerate(n.children or (n,))}
        out.append(here)
    return out


def shard_of(key: Column, root: Node) -> Column:
    """The leaf that ``key`` descends to: a hash draw for each child on the way down.

    Each level is one lookup of the children of the path so far, used once, so the
    expression grows with the depth, not with the number of shards.
    """
    text = F.coalesce(key.cast("string"), F.lit("null"))
    path, above = F.lit(""), {"": root}

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(text, child["path"]), 11)
        u = (bits.cast("double") + 0.5) / float(2 ** 53)
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["path"].alias("path"))
    for nodes in levels(root):
        below = {p: [] for p in above}
        for p, n in nodes.items():
            below[p.rsplit("/", 1)[0]].append(F.struct(F.lit(p).alias("path"), F.lit(float(n.weight)).alias("weight")))
        children = F.create_map(*[x for p, c in below.items() for x in (F.lit(p), F.array(*c))])
        path, above = F.array_min(F.transform(children[path], draw))["path"], nodes
    return F.create_map(*[F.lit(x) for p, n in above.items() for x in (p, n.shard)])[path].cast("int")


def shard_rows(docs: DataFrame, root: Node, grown: Node | None = None, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs``."""
    docs = anchored(docs)

    def rows(**more) -> DataFrame:
        df = positioned(docs, key=col(key), **more).withColumn("chunk", F.floor(F.col("row") / CHUNK_ROWS))
        return df.withColumn("shard", shard_of(F.col("key"), root))
    # Rows of earlier chunks of the shard: one row per (shard, chunk), counted from the key alone.
    counts = rows().groupBy("shard", "fh", "chunk").agg(F.count("*").alias("n"))
    w = Window.partitionBy("shard").orderBy("fh", "chunk")
    before = counts.select("shard", "fh", "chunk", (F.sum("n").over(w) - F.col("n")).alias("before"))
    body = rows(size=F.coalesce(F.octet_length(col(text)), F.lit(0)).cast("long") + 1,
                text_crc32=F.crc32(F.coalesce(col(text), F.lit("")).cast("binary")))
    inside = F.row_number().over(Window.partitionBy("shard", "fh", "chunk").orderBy("row")) - 1
    out = body.withColumn("inside", inside).join(before, ["shard", "fh", "chunk"])
    out = out.withColumn("grown_shard", shard_of(F.col("key"), grown) if grown else F.lit(None).cast("int"))
    return out.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
        "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"), "grown_shard")
