"""Operator 12, mixing sources to target weights by a low-discrepancy schedule.

Sources get targets in words by weight, at most ``repeats`` times what they hold
(water filling: what a source can't take goes to the others by weight). Each source's
rows, in a shuffled order fixed by a digest of doc_id and text, are one long run of
words, repeated as often as needed and cut into blocks of ``block`` words; the last
block of a source ends at its target. The schedule has one slot for each block of the
mix: slot t stands at the golden-ratio point t*g mod T, with g the number nearest to
T / golden ratio that has no divisor in common with T, and belongs to the source in whose share of
the cumulated weights that point falls. Slots are ranked per source, and the r-th slot
of a source takes its r-th block. As t*g mod T meets every point once, each source gets
exactly its number of slots and words, and any stretch of the schedule holds the
sources in near proportion.

No task holds a source: slots are ranked in chunks of the schedule and rows are placed
in ranges of the digest, each with offsets from one count per chunk or range. Equal
rows are counted before the shuffle.

Defined cases: a null text has no words; null doc_ids are ids like any other; sources
stand by code point, null last; equal rows are placed one after the other; rows without
words and rows beyond the target have ``taken`` 0; without any words all targets are 0;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.llm.common import col, small, stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: How often a document may be taken at most.
REPEATS = 3
#: Words of a block.
BLOCK = 512
#: Rows of a range of the shuffled order, slots of a chunk of the schedule, copies placed at a time.
RANGE_ROWS, CHUNK_SLOTS, CHUNK_COPIES = 8_192, 65_536, 4_096


def rows_of(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """source, doc_id, size, digest, copies: equal rows counted."""
    body = F.coalesce(col(text), F.lit(""))
    mark = F.md5(F.concat(F.coalesce(col(doc_id).cast("string"), F.lit("-")), F.lit(":"), body).cast("binary"))
    rows = docs.select(col(source).alias("source"), col(doc_id).alias("doc_id"), mark.alias("digest"),
                       F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"))
    return stage(rows.groupBy("source", "doc_id", "size", "digest").agg(F.count("*").alias("copies")), "rows")


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK) -> DataFrame:
    """One row per source: sid, source, n, source_size, target, quota (words to take), slots, first (slots before)."""
    s = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n"))
    # windows over all sources: one row each, as many as a user gives weights to
    s = s.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
    wheel = F.array(*[F.lit(w) for w in weights])
    s = s.withColumn("weight", F.element_at(wheel, (F.col("sid") % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("most", F.col("source_size") * repeats)
    by_fill = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    full = F.sum("most").over(by_fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("most")
    open_ = F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(every) - full).cast("double") / open_)
    # sources below the level are full; it is highest where exactly these are counted as full
    s = s.withColumn("target", F.least(F.col("most").cast("double"), F.max("level").over(every) * F.col("weight")))
    s = s.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
    s = s.withColumn("slots", F.floor((F.col("quota") + block - 1) / block).cast("long"))
    s = s.withColumn("first", F.sum("slots").over(Window.orderBy("sid")) - F.col("slots"))
    return stage(s.select("sid", "source", "n", "source_size", "target", "quota", "slots", "first"), "sources")


def golden_step(slots: int) -> int:
    """The number nearest to ``slots`` / golden ratio that shares no divisor with ``slots``."""
    unit = 10 ** 30
    start = 2 * unit * slots // (unit + math.isqrt(5 * unit * unit))
    return next((g for d in range(slots + 1) for g in (start - d, start + d) if g > 0 and math.gcd(g, slots) == 1), 1)


def schedule(plan: DataFrame) -> DataFrame:
    """sid, block, slot: the rank-th slot of each source, in schedule order."""
    total = plan.agg(F.sum("slots")).first()[0] or 0
    back = pow(golden_step(total), -1, total) if total else 0
    some = plan.where("slots > 0").select("sid", "slots", "first", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK_SLOTS))).alias("c"))
    start = F.col("c") * CHUNK_SLOTS
    points = some.repartition("sid", "c").select("sid", F.explode(F.sequence(
        F.col("first") + start, F.col("first") + F.least(start + CHUNK_SLOTS, F.col("slots")) - 1)).alias("point"))
    # point = slot * step mod total, so slot = point * (inverse of step) mod total
    slot = (F.col("point").cast("decimal(18,0)") * F.lit(back).cast("decimal(18,0)")) % F.lit(max(total, 1)).cast("decimal(18,0)")
    points = points.select("sid", slot.cast("long").alias("slot"))
    points = stage(points.withColumn("c", F.floor(F.col("slot") / CHUNK_SLOTS)), "slots")
    counts = points.groupBy("sid", "c").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("c")) - F.col("n")
    rank = F.row_number().over(Window.partitionBy("sid", "c").orderBy("slot")) - 1
    ranked = points.withColumn("rank", rank).join(counts.select("sid", "c", before.alias("before")), ["sid", "c"])
    return ranked.select("sid", (F.col("before") + F.col("rank")).alias("block"), "slot")


def places(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """sid, doc_id, size, pos (first word in its source's run) and the source's figures: one row per document row."""
    p = small(plan.withColumnRenamed("source", "name"))
    rows = rows.join(p, F.col("source").eqNullSafe(F.col("name"))).drop("name", "slots", "first")
    share = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") / 2.0 ** 32
    rows = rows.withColumn("range", F.floor(share * F.ceil(F.col("n") / RANGE_ROWS)))
    words = F.col("size") * F.col("copies")
    sums = rows.groupBy("sid", "range").agg(F.sum(words).alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("sid").orderBy("range")) - F.col("sum")
    inside = F.sum(words).over(Window.partitionBy("sid", "range").orderBy("digest", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - words
    rows = rows.withColumn("inside", inside).join(sums.select("sid", "range", before.alias("before")), ["sid", "range"])
    keep = ["sid", "source", "source_size", "target", "quota", "doc_id", "size"]
    some = rows.select(*keep, "copies", (F.col("before") + F.col("inside")).alias("from"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK_COPIES))).alias("c"))
    start = F.col("c") * CHUNK_COPIES
    some = some.repartition("sid", "from", "c").select(*keep, "from", F.explode(F.sequence(
        start, F.least(start + CHUNK_COPIES, F.col("copies")) - 1)).alias("copy"))
    return some.select(*keep, (F.col("from") + F.col("copy") * F.col("size")).alias("pos"))


def pieces(placed: DataFrame, slots: DataFrame, block: int = BLOCK, repeats: int = REPEATS) -> DataFrame:
    """``placed`` joined to the schedule: slot, block, and first and last (exclusive) word of the document
    that the slot takes; slot null where nothing is taken."""
    turn = F.explode_outer(F.filter(F.array(*[F.lit(e) for e in range(repeats)]), lambda e: (
        (F.col("size") > 0) & (F.col("pos") + e * F.col("source_size") < F.col("quota")))))
    rows = placed.withColumn("turn", turn).withColumn("at", F.col("pos") + F.col("turn") * F.col("source_size"))
    end = F.least(F.col("at") + F.col("size"), F.col("quota"))
    spans = F.sequence(F.floor(F.col("at") / block), F.floor((end - 1) / block))
    rows = rows.withColumn("end", end).withColumn("block", F.explode_outer(spans))
    rows = rows.join(slots, ["sid", "block"], "left")
    first = F.greatest(F.col("block") * block, F.col("at")) - F.col("at")
    last = F.least((F.col("block") + 1) * block, F.col("end")) - F.col("at")
    return rows.withColumn("first", F.when(F.col("slot").isNotNull(), first)).withColumn(
        "last", F.when(F.col("slot").isNotNull(), last)).drop("at", "end")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK) -> DataFrame:
    """The mixed stream: slot, source, turn, doc_id, first, last. Ordered by (slot, first) it reads in mixed order;
    words first to last of doc_id's text belong to that slot."""
    rows = rows_of(docs)
    plan = targets(rows, weights, repeats, block)
    out = pieces(places(rows, plan), schedule(plan), block, repeats)
    return out.where("slot is not null").select("slot", "block", "source", "turn", "doc_id", "first", "last")


def taken(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, size, source, source_size, target, taken: one row per row of ``docs``."""
    rows = rows_of(docs)
    plan = targets(rows)
    placed = stage(places(rows, plan), "places")
    keys = ["sid", "pos", "doc_id", "size", "source", "source_size", "target"]
    out = pieces(placed.where("size > 0"), schedule(plan)).groupBy(*keys).agg(
        F.coalesce(F.sum(F.col("last") - F.col("first")), F.lit(0)).cast("long").alias("taken"))
    none = placed.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return out.unionByName(none).drop("sid", "pos")
