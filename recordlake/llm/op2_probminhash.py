"""Operator 2, near-duplicates: ProbMinHash signatures, banding, verification.

Each distinct five-word shingle of a text is a Poisson process: its arrivals come at
exponential distances of rate *weight*, each into one register chosen evenly. A register
keeps the element of the earliest arrival. Elements are advanced in rounds and leave as
soon as their next arrival is later than the latest register of their text (early
termination). Two signatures agree in a register with the probability Jaccard similarity of
the weighted sets. Every weight is 1 here, however often a shingle occurs, so that is the
Jaccard similarity of the shingle sets, by which links are decided.

Bands of registers become bucket keys; of buckets with the same members one is kept. Texts that are equal
after normalisation are one node, combined before any shuffle. In each bucket some centres are compared with the
members of other classes found so far, if compact signatures don't show them too unlike;
then classes are merged, and what is left gets new centres. The first centres are the members
that meet most others, the same in all buckets of a group, so most classes are whole after few
comparisons. Then every open member's shingles that no other open member has are counted: they
bound its similarity to any other, and members or pairs whose bound is too low are done without
a comparison. In buckets of more than ``CROWD`` open members only shingles that many texts have count
for that bound; pairs that share a rarer one are found by the rare shingles themselves, so outliers of
a crowd aren't compared with all of it. Only members outside a bucket's
largest class ever become centres, each once, and a bucket is done when none is left, so
every two members have then been compared, bounded or are in one class. A group of near copies soon is
one class, so buckets aren't expanded into all their pairs, and no bucket has a cap. Every
comparison is the exact similarity of the shingle sets, at least 0.8 for a link. Classes are
the connected components of the links.

Defined cases: null, empty and wordless texts are each a class of their own; a text
of fewer than five words has one shingle; equal rows share a class; the document that
stays is the one with the smallest (doc_id, file hash, row), null ids first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.llm.common import WORKER, anchored, chunks, col, keep_positions, positioned, small, stage
from recordlake.llm.shingles import mix, shingle_hashes

SIMILARITY = 0.8
BANDS, ROWS = 36, 7  # a pair at 0.8 shares no band with a chance of 0.0002
#: Four bits of each of the 252 registers; a pair at 0.8 differs in 47 registers on average, with a
#: standard deviation of 6.2, so in more than this with a chance of 0.00003.
WORDS_OF_BITS, PLANES = 4, 4
MOST_UNLIKE = 72
#: First rounds compare only pairs that are probably links, to merge classes with few comparisons.
FIRST_ROUNDS, LIKELY = 2, 44
#: Centres a bucket and round: this many times more each round, so rounds grow with the logarithm of a bucket.
SLOT_GROWTH = 16
#: Open members beyond which a bucket is a crowd. A shingle is rare in a crowd of k texts if at most sqrt(k) have it.
CROWD = 64
#: Characters of text that a task sketches at once.
CHUNK_CHARS = 1_000_000


def uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1], from 64 random bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / float(2 ** 53)


def weighted(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text: text index, element, weight, sorted."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return t[at], h[at], np.diff(np.append(at, len(t))).astype(np.float64)


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int,
               registers: int) -> np.ndarray:
    """Winning element per text and register (0 where a text has no element)."""
    time = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, np.uint64)
    size = np.bincount(text, minlength=texts)
    alone = size[text] == 1              # every register of a one-element text is that element's
    winner.reshape(texts, registers)[text[alone]] = element[alone, None]
    alive = np.flatnonzero(~alone)
    seed, arrival = element[alive], np.zeros(len(alive))
    while len(alive):
        seed = mix(seed + np.uint64(0x9E3779B97F4A7C15))
        arrival = arrival - np.log(uniform(seed)) / weight[alive]
        register = ((mix(seed ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) * np.uint64(registers)
                    >> np.uint64(32)).astype(np.int64)
        slot = text[alive] * registers + register
        np.minimum.at(time, slot, arrival)
        won = time[slot] == arrival
        winner[slot[won]] = element[alive[won]]
        here, back = np.unique(text[alive], return_inverse=True)
        going = arrival < time.reshape(texts, registers)[here].max(axis=1)[back]
        alive, seed, arrival = alive[going], seed[going], arrival[going]
    return winner.reshape(texts, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows][:, :bands])
    return mix(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)


def compact(signature: np.ndarray) -> np.ndarray:
    """Four bits of every register as 16 numbers: word w, plane p at 4w + p."""
    out = np.zeros((len(signature), WORDS_OF_BITS * PLANES), np.uint64)
    value = mix(signature + np.uint64(0x632BE59BD9B4E019))
    for w, part in enumerate(np.array_split(np.arange(signature.shape[1]), WORDS_OF_BITS)):
        for k, r in enumerate(part):
            for p in range(PLANES):
                out[:, PLANES * w + p] |= (value[:, r] >> np.uint64(p) & np.uint64(1)) << np.uint64(k)
    return out.view(np.int64)


def unlike(a: str, b: str):
    """Number of registers whose four bits differ."""
    words = [[F.col(a)[PLANES * w + p].bitwiseXOR(F.col(b)[PLANES * w + p]) for p in range(PLANES)]
             for w in range(WORDS_OF_BITS)]
    return reduce(lambda x, y: x + y, [F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), planes)) for planes in words])


def _content(hashes: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """A 128-bit digest of each text's shingle sequence; None without shingles."""
    n = np.diff(offsets)
    place = np.arange(offsets[-1], dtype=np.uint64) - np.repeat(offsets[:-1], n).astype(np.uint64)
    out = np.zeros((2, len(n)), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        for k, salt in enumerate((0x2545F4914F6CDD1D, 0xD1342543DE82EF95)):
            terms = mix(hashes + mix(place + np.uint64(salt)))
            out[k, full] = mix(np.add.reduceat(terms, offsets[:-1][full]) + n[full].astype(np.uint64))
    return [out[:, i].tobytes() if n[i] else None for i in range(len(n))]


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS,
           rows: int = ROWS) -> DataFrame:
    """doc_id, fh, row, node (digest of the words; null without words), bands, bits (the compact
    signature): both null but in one row of each text that a task sees."""
    src = positioned(docs, doc_id=col(doc_id), text=col(text))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        WORKER.clear()
        for batch, texts in chunks(batches, most=CHUNK_CHARS):
            hashes, offsets = shingle_hashes(texts)
            nodes = _content(hashes, offsets)
            first: dict[bytes, int] = {}
            for i, d in enumerate(nodes):
                if d is not None:
                    first.setdefault(d, i)
            pick = np.fromiter(first.values(), np.int64, len(first))
            t, e, _ = weighted(*_subset(hashes, offsets, pick))
            signature = signatures(t, e, np.ones(len(e)), len(pick), bands * rows)  # the measure of ``compare``
            keys, bits = band_keys(signature, bands, rows), compact(signature)
            place = {d: k for k, d in enumerate(first)}
            mine = [place[d] if d is not None and first[d] == i else None for i, d in enumerate(nodes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "fh", "row")]
                + [pa.array(nodes, pa.binary())]
                + [pa.array([None if k is None else x[k] for k in mine], pa.list_(pa.int64())) for x in (keys, bits)],
                ["doc_id", "fh", "row", "node", "bands", "bits"])
            del batch, texts  # not held while the next are read
    return src.mapInArrow(run, f"doc_id {kind}, fh long, row long, node binary, bands array<long>, bits array<long>")


def _subset(hashes: np.ndarray, offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(offsets)[pick]
    out = np.concatenate([[0], np.cumsum(n)])
    return hashes[np.repeat(offsets[:-1][pick], n) + np.arange(out[-1]) - np.repeat(out[:-1], n)], out


def shingle_sets(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """node, shingles (sorted, distinct) of the texts at ``wanted`` (node, fh, row)."""
    src = positioned(docs, text=col(text)).join(wanted, ["fh", "row"]).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, most=CHUNK_CHARS):
            t, e, _ = weighted(*shingle_hashes(texts))
            at = np.searchsorted(t, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("node")),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(e.view(np.int64)))], ["node", "shingles"])
            del batch, texts
    return src.mapInArrow(run, "node binary, shingles array<long>")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...; staged) with ``sim``, the exact Jaccard similarity of their shingle sets. Only the sets
    that the pairs name are shuffled."""
    named = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "compared")
    sets = sets.join(small(named), "node", "left_semi")
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.withColumn("sim", shared / (F.size("sa") + F.size("sb") - shared)).drop("sa", "sb")


def components(edges: DataFrame) -> DataFrame:
    """node, comp: the smallest node of each connected component of ``edges`` (a, b).

    Alternates large and small stars; each round is written to the shared folder.
    Hubs are fine: neighbours' minima are aggregates, combined before the shuffle.
    """
    pairs = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u != v").distinct(), "edges")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large.where("u != v"), "large")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u != v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        after = stage(small, "small")
        n = after.count()
        if n == after.select("u").distinct().count() and not after.select("u").intersect(after.select("v")).take(1):
            break
        pairs = after
    stars = after.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stage(stars.unionByName(stars.select(F.col("comp").alias("node"), "comp").distinct()), "components")


def links(docs: DataFrame, sketched: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """a, b, sim: verified links between different normalised texts (enough to connect their
    classes, not all pairs); and node, comp: the class of every text that shares a bucket."""
    nodes = stage(sketched.where("node is not null").groupBy("node").agg(
        F.min(F.struct("fh", "row")).alias("at"), F.max("bands").alias("bands"), F.max("bits").alias("bits")), "nodes")
    rows = nodes.select("node", F.explode("bands").alias("key"))
    # Tables are staged before a join on a key that may be hot: Spark can split such a
    # key only where both sides are shuffled for the join itself.
    shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                     F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")).where("n > 1")
    # Buckets with the same members (equal in number and in two sums of 64 bits) are one: the others add no pair.
    shared = stage(shared.groupBy("n", "x", "y").agg(F.min("key").alias("key"), F.count("*").alias("times")), "shared")
    met = stage(rows.join(small(shared.select("key", (F.col("n") * F.col("times")).alias("n"))), "key"), "met")
    central = met.groupBy("node").agg(F.sum("n").alias("meets"))
    buckets = stage(met.select("key", "node").join(central, "node"), "buckets")
    members = buckets.select("node").distinct()
    wanted = stage(nodes.select("node", "at.fh", "at.row", "bits").join(members, "node"), "wanted")
    sets = stage(shingle_sets(docs, small(wanted.drop("bits")), text), "sets")
    bits = wanted.select("node", "bits")

    labels = stage(buckets.select("node", F.col("node").alias("comp")).distinct(), "labels")
    open_ = buckets.withColumns({"done": F.lit(False), "size": F.lit(0), "rest": F.lit(0)})
    found, tried, slots, round_ = None, None, 1, 0
    while True:
        round_ += 1
        first_rounds = round_ <= FIRST_ROUNDS
        named = stage(open_.join(labels, "node"), "named")
        top = (named.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key")
               .agg(F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("classes")))
        top = stage(top.where("classes > 1").select("key", F.col("top.comp").alias("top")), "top")
        active = stage(named.join(top, "key"), "active")
        rare = None
        if round_ == FIRST_ROUNDS + 1:
            active, rare = bounded(active, sets, similarity)
        waiting = active.where("comp != top and not done")
        by_chance = F.xxhash64("node", F.lit(round_))
        order = F.struct(by_chance) if round_ == FIRST_ROUNDS else F.struct("meets", by_chance)
        centres = waiting.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(slots)).alias("slot")).agg(
            F.max_by(F.struct("node", "comp", "size", "rest"), order).alias("c"))
        centres = stage(centres.select("key", F.col("c.node").alias("c"), F.col("c.comp").alias("cc"),
                                       F.col("c.size").alias("csize"), F.col("c.rest").alias("crest")), "centres")
        if not centres.take(1) and (rare is None or not rare.take(1)):
            break
        most = LIKELY if first_rounds else MOST_UNLIKE
        # A former centre has met all members; of two centres of a round, one is a member to the other.
        met = centres.select("key", F.col("c").alias("node"), F.lit(True).alias("met"))
        turn = active if first_rounds else active.join(met, ["key", "node"], "left").withColumn("met", F.coalesce("met", F.lit(False)))
        new_pair = F.lit(True) if first_rounds else ~F.col("done") & (~F.col("met") | (F.col("node") < F.col("c")))
        pairs = (turn.join(centres, "key").where(new_pair & (F.col("comp") != F.col("cc"))
                                                 & (F.lit(first_rounds) | can_link("size", "rest", "csize", "crest", similarity)))
                 .select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")))
        pairs = (pairs if rare is None else pairs.unionByName(rare)).distinct()
        pairs = stage(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "met")
        # compact signatures stay out of the buckets: only pairs fetch them, once however many buckets they share
        pairs = pairs.join(bits.select(F.col("node").alias("a"), F.col("bits").alias("ab")), "a").join(
            bits.select(F.col("node").alias("b"), F.col("bits").alias("bb")), "b")
        pairs = stage(pairs.where(unlike("ab", "bb") <= most).select("a", "b"), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = stage(compare(pairs, sets).where(F.col("sim") >= similarity), "links")
        found = new if found is None else found.unionByName(new)
        kept = ["key", "node", "meets", "size", "rest"]
        open_ = turn.select(*kept, "done" if first_rounds else (F.col("done") | F.col("met")).alias("done"))
        labels = merged(labels, new)
        slots *= 1 if first_rounds else SLOT_GROWTH
    if found is None:
        found = buckets.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(1.0).alias("sim")).limit(0)
    return found, labels


def can_link(size: str, rest: str, other_size: str, other_rest: str, similarity: float):
    """Whether two texts can be similar enough, going by the sizes of their shingle sets and of
    the parts of these that other texts have too."""
    most = F.least(rest, other_rest)
    return most >= similarity * (F.col(size) + F.col(other_size) - most) - 1e-6


def bounded(active: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``active`` with ``size`` (of a text's shingle set) and ``rest`` (those that another active text
    has too; in crowds those that aren't rare there). Texts whose ``rest`` is too small to be linked to any other
    are left out. And a, b: the pairs of different classes in crowds that may be linked by what they share of rare shingles."""
    mine = sets.join(active.select("node").distinct(), "node").select("node", F.xxhash64("node").alias("id"), "shingles")
    mine = stage(mine, "open")
    once = (mine.select("id", F.explode("shingles").alias("s")).groupBy("s")
            .agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1").groupBy("id").agg(F.count("*").alias("own")))
    sizes = mine.select("node", "id", F.size("shingles").alias("size")).join(once, "id", "left").select(
        "node", "size", (F.col("size") - F.coalesce("own", F.lit(0))).cast("int").alias("rest"))
    sizes = stage(sizes.where(F.col("rest") >= similarity * F.col("size") - 1e-6), "sizes")
    active = stage(active.drop("size", "rest").join(sizes, "node"), "active")
    crowds = stage(active.groupBy("key").agg(F.count("*").alias("crowd")).where(F.col("crowd") > CROWD), "crowds")
    if not crowds.take(1):
        return active, None
    inside = active.join(small(crowds), "key").groupBy("node").agg(F.max("crowd").alias("crowd"), F.first("comp").alias("comp"))
    common, rare = crowded(stage(mine.drop("id").join(inside, "node"), "inside"), similarity)
    active = active.join(small(crowds), "key", "left").join(common, "node", "left").withColumn(
        "rest", F.when(F.col("crowd").isNull(), F.col("rest")).otherwise(F.coalesce("common", F.lit(0))).cast("int"))
    active = active.where(F.col("rest") >= similarity * F.col("size") - 1e-6).drop("crowd", "common")
    return stage(active, "active"), rare


def crowded(texts: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """For ``texts`` (node, shingles, crowd, comp; staged): node, common (its shingles that aren't rare); and a, b: pairs of
    different classes that share a rare shingle, among them all similar enough that share one.

    Shingles are ordered by (rare first, texts that have them, hash). What similar texts share first in this order is among
    the first shingles of both, as many as either can have that the other hasn't, and one more. If it isn't rare,
    they share no rare one. At most sqrt(crowd) texts have a rare shingle, so these pairs grow slower than a crowd's square.
    """
    each = texts.select("node", "crowd", F.explode("shingles").alias("s"))
    shared = each.groupBy("s").agg(F.count("*").alias("n"), F.max("crowd").alias("crowd")).where("n > 1")
    shared = stage(shared.select("s", "n", (F.col("n") * F.col("n") <= F.col("crowd")).alias("rare")), "shared")
    each = stage(each.drop("crowd").join(shared, "s"), "each")
    counts = each.groupBy("node").agg(F.count("*").alias("rest"), F.count_if(~F.col("rare")).alias("common"))
    size = F.size("shingles")
    apart = texts.join(counts, "node").select(
        "node", "comp", (F.col("rest") + 1 - F.ceil(similarity * size - 1e-6)).alias("first"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("n", "s"))
    first = each.where("rare").withColumn("place", place).join(apart, "node").where("place <= first")
    first = stage(first.select("s", "node", "comp"), "first")
    pairs = first.select("s", F.col("node").alias("a"), F.col("comp").alias("ca")).join(
        first.select("s", F.col("node").alias("b"), F.col("comp").alias("cb")), "s")
    pairs = pairs.where("a < b and ca != cb").select("a", "b").distinct()
    return counts.select("node", "common"), stage(pairs, "rare")


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, comp) after the classes that ``edges`` (a, b: nodes) connect became one.

    Edges between labels are contracted over and over: each label becomes the smallest one at most
    two edges away, which leaves a fraction of them, until no edge joins different labels. Hubs are
    fine: neighbours' minima are aggregates, combined before the shuffle.
    """
    name = labels.select(F.col("node").alias("a"), F.col("comp").alias("u"))
    ends = edges.join(name, "a").join(name.select(F.col("a").alias("b"), F.col("u").alias("v")), "b")
    ends = stage(ends.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "ends")
    while ends.take(1):
        both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        far = both.join(near, "v").groupBy("u").agg(F.min("m").alias("m"))
        far = stage(far.select(F.col("u").alias("comp"), F.least("u", "m").alias("to")), "smallest")
        labels = stage(labels.join(far, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "labels")
        left = ends.join(far.select(F.col("comp").alias("u"), F.col("to").alias("a")), "u").join(
            far.select(F.col("comp").alias("v"), F.col("to").alias("b")), "v").where("a != b")
        ends = stage(left.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "ends")
    return labels


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, fh, row, class_id (doc_id of the row that stays), class_size, n_links_tried
    (links to other texts among the pairs that were compared, enough to connect the class, not all), kept: one
    row per row of ``docs``."""
    docs = anchored(docs)
    sketched = stage(sketch(docs, doc_id, text), "sketch")
    found, comps = links(docs, sketched, similarity, text)
    ends = found.select(F.explode(F.array("a", "b")).alias("node"))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links_tried"))
    nodes = (sketched.where("node is not null").groupBy("node")
             .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "fh", "row")).alias("first"))
             .join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    classes = nodes.groupBy("comp").agg(F.sum("n").alias("class_size"), F.min("first").alias("first")).where("class_size > 1")
    labels = stage(nodes.select("node", "comp").join(classes, "comp").join(degree, "node", "left")
                   .select("node", "class_size", "first", F.coalesce("n_links_tried", F.lit(0)).alias("n_links_tried")), "labels")
    me = F.struct("doc_id", "fh", "row")
    out = sketched.select("doc_id", "fh", "row", "node").join(labels, "node", "left")
    return out.select("doc_id", "fh", "row",
                      F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
                      F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
                      F.coalesce("n_links_tried", F.lit(0)).cast("long").alias("n_links_tried"),
                      F.coalesce(F.col("first") == me, F.lit(True)).alias("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each class, with all columns of ``docs``."""
    docs = anchored(docs)
    gone = stage(near_classes(docs).where("not kept").select("fh", "row"), "near")
    return keep_positions(docs, gone, "left_anti")
