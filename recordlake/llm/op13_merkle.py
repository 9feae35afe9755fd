"""Operator 13, Merkle dataset manifest with octopus multiproofs.

Every row is a leaf: the digest of its fields. Leaves of one tree value (a language)
ascend by their order column and are paired level by level up to a subroot; subroots,
ordered by tree value, are the leaves of one more tree, whose last node is the root.

Leaves are placed by a range shuffle and counts per (part, tree), so a tree that holds
a third of all rows is spread over many tasks. ``LEVELS`` levels are folded at a time,
in aligned blocks of 2**LEVELS nodes, so no task sees more than a block of a tree.

Proofs are made a leaf partition (the wanted leaves of one block) at a time: from the
indices it holds it computes the minimal union of node coordinates that it can't derive
itself, up to the root, fetches these in one join with the node table, derives the
interiors that its leaves share, and expands every leaf's own proof from them.

Defined cases: null fields count as ``-``; a null tree value is a tree of its own, the
first; rows of equal order value stand in the order of their digests (null order values
first), so equal rows are leaves of their own; an empty table gives no rows and has no
root; a node without a sibling is hashed alone; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.llm.common import anchored, col, positioned, small, stage

#: Levels of the tree that one round folds; a block has 2**LEVELS nodes.
LEVELS = 10
#: Tree number of the tree over the subroots.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Manifest:
    """``leaves``: t, i, block, size, leaf and the columns kept; ``nodes``: t, level, i, hash
    of every node; ``trees``: number of trees; ``root``: None for no rows."""
    leaves: DataFrame
    nodes: DataFrame | None
    trees: int
    root: str | None


def digest(fields: Iterable[Column]) -> Column:
    """Digest of a row: each field as ``-`` or its UTF-8 byte count, a colon and its text."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[one(c) for c in fields]).cast("binary"), 256)


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth(size: int) -> int:
    """Levels above the leaves of a tree of ``size`` leaves."""
    return (size - 1).bit_length()


def width(size: int, level: int) -> int:
    """Nodes of a level."""
    return -(-size // (1 << level))


def missing(indices: Iterable[int], size: int) -> list[tuple[int, int]]:
    """(level, index) of the fewest nodes that, with the leaves ``indices``, give all paths to the top."""
    known, out = set(indices), []
    for level in range(depth(size)):
        out += [(level, k ^ 1) for k in sorted(known) if k ^ 1 not in known and k ^ 1 < width(size, level)]
        known = {k >> 1 for k in known}
    return out


def derive(nodes: dict[tuple[int, int], str], indices: Iterable[int], size: int) -> None:
    """Add to ``nodes``, which holds the leaves ``indices`` and what ``missing`` named, all nodes above these leaves."""
    known = set(indices)
    for level in range(depth(size)):
        last = width(size, level) - 1
        known = {k >> 1 for k in known}
        for k in known:
            pair = (nodes[level, 2 * k],) if 2 * k == last else (nodes[level, 2 * k], nodes[level, 2 * k + 1])
            nodes[level + 1, k] = h(*pair)


def path(nodes: dict[tuple[int, int], str], i: int, size: int) -> list[tuple[bool, str | None]]:
    """For each level from leaf ``i`` up: whether the sibling stands left, and its digest (None: no sibling)."""
    out = []
    for level in range(depth(size)):
        k = (i >> level) ^ 1
        out.append((k < i >> level, nodes[level, k] if k < width(size, level) else None))
    return out


def fold(leaf: str, steps: Iterable[tuple[bool, str | None]]) -> str:
    for left, other in steps:
        leaf = h(leaf) if other is None else h(other, leaf) if left else h(leaf, other)
    return leaf


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` (staged) with t (number of the tree value), i (index in the tree) and size (leaves of the tree)."""
    keys = [tree, *order]
    ordered = stage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("at", F.monotonically_increasing_id()), "ordered")
    # rows of one tree stand side by side in a part, so an index is a place less the place of the first
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    spans = stage(ordered.groupBy(tree, "part").agg(F.min("at").alias("first"), F.count("*").alias("n")), "spans")
    names = spans.groupBy(F.col(tree).alias("name")).agg(F.sum("n").alias("size"))
    names = names.withColumn("t", F.row_number().over(Window.orderBy(F.col("name").asc_nulls_first())).cast("long") - 1)
    before = F.sum("n").over(Window.partitionBy(tree).orderBy("part")) - F.col("n")
    spans = spans.withColumn("before", before)
    spans = stage(spans.join(names, F.col(tree).eqNullSafe(F.col("name"))).select(
        F.col("part").alias("p"), "name", "t", "size", (F.col("before") - F.col("first")).alias("shift")), "places")
    out = ordered.join(small(spans), (F.col("part") == F.col("p")) & F.col(tree).eqNullSafe(F.col("name")))
    return out.withColumn("i", F.col("at") + F.col("shift")).drop("at", "part", "p", "name", "shift", *order[2:])


def _round(base: int):
    def run(key, group):
        t, size = key[0].as_py(), group.column("size")[0].as_py()
        at = sorted(zip(group.column("i").to_pylist(), group.column("hash").to_pylist()))
        first, here = at[0][0], [x[1] for x in at]
        rows = [(base, first + n, x) for n, x in enumerate(here)] if base == 0 else []
        for level in range(base, min(base + LEVELS, depth(size))):
            first //= 2
            here = [h(*here[n:n + 2]) for n in range(0, len(here), 2)]
            rows += [(level + 1, first + n, x) for n, x in enumerate(here)]
        levels, places, hashes = zip(*rows) if rows else ((), (), ())
        return pa.table({"t": pa.array([t] * len(rows), pa.int64()), "level": pa.array(levels, pa.int32()),
                         "i": pa.array(places, pa.int64()), "hash": pa.array(hashes, pa.string()),
                         "size": pa.array([size] * len(rows), pa.int64())})
    return run


def build(leaves: DataFrame, largest: int) -> DataFrame:
    """t, level, i, hash, size of all nodes over ``leaves`` (t, i, hash, size); ``largest``: the largest size."""
    base, here, out = 0, leaves, None
    while True:
        blocks = here.groupBy("t", F.shiftright("i", LEVELS).alias("block"))
        nodes = stage(blocks.applyInArrow(_round(base), "t long, level int, i long, hash string, size long"), "nodes")
        out = nodes if out is None else out.unionByName(nodes)
        base += LEVELS
        if depth(largest) <= base:
            return out
        here = nodes.where(F.col("level") == base).select("t", "i", "hash", "size")


def top_level(size: Column) -> Column:
    return F.when(size == 1, 0).otherwise(F.length(F.bin(size - 1)))


def manifest(docs: DataFrame, tree: str = "lang", order: str = "doc_id", fields: Iterable[str] = FIELDS,
             **keep: Column) -> Manifest:
    """The trees over ``docs``; ``keep`` are more columns of the leaf rows."""
    docs = anchored(docs)
    rows = stage(positioned(docs, tree=col(tree), order=col(order), leaf=digest(col(f) for f in fields), **keep), "leaves")
    leaves = stage(placed(rows, "tree", ["order", "leaf", "fh", "row"]), "placed")
    leaves = leaves.withColumn("block", F.shiftright("i", LEVELS))
    largest, last = leaves.agg(F.max("size"), F.max("t")).first()
    if largest is None:
        return Manifest(leaves, None, 0, None)
    nodes = build(leaves.select("t", "i", F.col("leaf").alias("hash"), "size"), largest)
    subroots = nodes.where(F.col("level") == top_level(F.col("size"))).select(
        F.lit(TOP).cast("long").alias("t"), F.col("t").alias("i"), "hash", F.lit(last + 1).cast("long").alias("size"))
    top = build(subroots, last + 1)
    root = top.where(F.col("level") == depth(last + 1)).first()["hash"]
    return Manifest(leaves, nodes.unionByName(top).drop("size"), last + 1, root)


def _wanted(trees: int):
    def run(key, group):
        t, block = (k.as_py() for k in key)
        size = group.column("size")[0].as_py()
        rows = [(t, *x) for x in missing(group.column("i").to_pylist(), size)]
        rows += [(TOP, *x) for x in missing([t], trees)]
        return pa.table({"t": pa.array([t] * len(rows), pa.int64()), "block": pa.array([block] * len(rows), pa.int64()),
                         "of": pa.array([r[0] for r in rows], pa.int64()), "level": pa.array([r[1] for r in rows], pa.int32()),
                         "i": pa.array([r[2] for r in rows], pa.int64())})
    return run


def _expand(trees: int, extra: str | None):
    def run(key, group, fetched):
        t, size = key[0].as_py(), group.column("size")[0].as_py()
        at, leaf = group.column("i").to_pylist(), group.column("leaf").to_pylist()
        own = {(0, i): x for i, x in zip(at, leaf)}
        top: dict[tuple[int, int], str] = {}
        for of, level, i, x in zip(*[fetched.column(c).to_pylist() for c in ("of", "level", "i", "hash")]):
            (top if of == TOP else own)[level, i] = x
        derive(own, at, size)
        subroot = own[depth(size), 0]
        above = path(top, t, trees)
        proofs, roots = [], []
        start = group.column(extra).to_pylist() if extra else [None] * len(at)
        for i, x, other in zip(at, leaf, start):
            steps = path(own, i, size) + above
            proofs.append(h(*[s for _, s in steps if s is not None]))
            roots.append(fold(x if other is None else other, steps))
        out = group.select(["order", "leaf"])
        for name, values in (("subroot", [subroot] * len(at)), ("proof_sha256", proofs), ("folded_root", roots)):
            out = out.append_column(name, pa.array(values, pa.string()))
        return out
    return run


def prove(m: Manifest, leaves: DataFrame | None = None, altered: str | None = None) -> DataFrame:
    """order, leaf, subroot, root, proof_sha256, folded_root, verified of each of ``leaves`` (rows of
    ``m.leaves``; all by default). ``altered`` names a column with the digest to fold instead of the leaf's
    own where it isn't null."""
    leaves = m.leaves if leaves is None else leaves
    kind = dict(leaves.dtypes)["order"]
    schema = f"order {kind}, leaf string, subroot string, proof_sha256 string, folded_root string"
    if m.root is None:
        none = F.lit(None).cast("string")
        return leaves.select("order", "leaf", none.alias("subroot"), none.alias("root"), none.alias("proof_sha256"),
                             none.alias("folded_root"), F.lit(None).cast("boolean").alias("verified"))
    used = leaves.select("t", "block", "i", "size", "leaf", "order", *([altered] if altered else []))
    wanted = used.select("t", "block", "i", "size").groupBy("t", "block").applyInArrow(
        _wanted(m.trees), "t long, block long, of long, level int, i long")
    nodes = m.nodes.select(F.col("t").alias("of"), "level", "i", "hash")
    fetched = stage(wanted.join(nodes, ["of", "level", "i"]), "fetched")
    out = used.groupBy("t", "block").cogroup(fetched.groupBy("t", "block")).applyInArrow(_expand(m.trees, altered), schema)
    root = F.lit(m.root)
    return out.select("order", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == root).alias("verified"))


def tamper_check(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``; where 7 divides the checksum of doc_id, n_chars is tampered with (one more)
    and the proof must fail."""
    changed = {f: col(f) for f in FIELDS} | {"n_chars": col("n_chars") + 1}
    hit = (F.crc32(col("doc_id").cast("string").cast("binary")) % 7 == 0) & col("n_chars").isNotNull()
    m = manifest(docs, altered=F.when(hit, digest(changed.values())))
    return prove(m, altered="altered").withColumnRenamed("order", "doc_id")
