"""Operator 4, benchmark decontamination by size-partitioned MinHash containment search.

Documents are partitioned by their number of five-word shingles into classes of upper
size 32, 64, 128 and 256; longer ones are cut into segments of 256 shingles. Class *u*
has one-permutation MinHash sketches of 4u bins: the smallest hash in each bin. A test
item has one sketch per class. A segment that shares a bin's minimum with an item's
sketch makes (document, item) a candidate. At a bin load of at most 1/4 a common shingle
is a common minimum with a chance of about 0.85, so an item of ten shingles, eight of
them in the document, is missed with a chance below 1e-6 whatever the document's length;
that is what the partition by size buys. Items of up to ``EXACT`` shingles leave nothing to
chance: each of their shingles in a document makes a candidate. Candidates are then verified
by the exact share of the item's distinct shingles that occur in the document, at least 0.8.
Items of fewer than five words are searched as the sequence of all their words, which is
then their one shingle.

The index of items may be of any size: tasks get only a bitmap of its hashes (at most
2^25 bits, built by Spark), and what passes is joined to the index by Spark.

Defined cases: null, empty and wordless texts contain nothing and match nothing; ``shortest``
leaves out items of fewer words; repeated items and documents give one row for each pair of
rows' ids and positions; empty tables give no rows; other columns are ignored, and kept
by ``drop_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import anchored, chunks, col, keep_positions, positioned, stage, table
from recordlake.llm.shingles import WORDS, mix, shingle_hashes, word_hashes

CONTAINMENT = 0.8
SIZES = (32, 64, 128, 256)
BINS = 4
EXACT = 12  # items of up to so many shingles are found without sketches
BITS = 2 ** 25
_BUCKET = 32_768  # bits of one bitmap row
#: Characters of text that a task sketches at once.
CHUNK_CHARS = 500_000


def sketch(hashes: np.ndarray, group: np.ndarray, groups: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation MinHash: (group, smallest hash) of every bin that isn't empty."""
    least = np.full(groups * bins, np.iinfo(np.uint64).max, np.uint64)
    place = (mix(hashes ^ np.uint64(bins)) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
    np.minimum.at(least, group * bins + place.astype(np.int64), hashes)
    full = np.flatnonzero(least != np.iinfo(np.uint64).max)
    return full // bins, least[full]


def segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment number of every shingle, and the size class of every segment."""
    most = SIZES[-1]
    pieces = -(-counts // most)
    first = np.cumsum(pieces) - pieces
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    seg = np.repeat(first, counts) + inside // most
    size = np.bincount(seg, minlength=pieces.sum())
    whole = np.repeat(counts, pieces)
    return seg, np.searchsorted(SIZES, np.where(whole > most, most, size))


def short_class(words: int) -> int:
    """Class of the word sequences of items of ``words`` words, fewer than a shingle's."""
    return words - WORDS - 1


def item_index(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, at (a row number), hash, size class (-1: a shingle of the item itself;
    k - 6: all k words of an item of fewer than five), n (its number of distinct shingles); items without
    words have no rows."""
    src = positioned(items, item_id=col(item_id), text=col(text))
    kind = src.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, most=CHUNK_CHARS):
            words = np.diff(word_hashes(texts)[1])
            hashes, offsets = shingle_hashes([t if n >= WORDS else None for t, n in zip(texts, words)])
            text_of = np.repeat(np.arange(len(texts)), np.diff(offsets))
            pairs = np.unique(np.stack([text_of.astype(np.uint64), hashes]), axis=1)
            who, h = pairs[0].astype(np.int64), pairs[1]
            n = np.bincount(who, minlength=len(texts))
            parts = [(who, h, np.full(len(h), -1))]
            for c, u in enumerate(SIZES):
                g, least = sketch(h, who, len(texts), BINS * u)
                parts.append((g, least, np.full(len(g), c)))
            for k in range(1, WORDS):
                own = np.flatnonzero(words == k)
                parts.append((own, shingle_hashes([texts[i] for i in own], k)[0], np.full(len(own), short_class(k))))
                n[own] = 1
            who, h, c = (np.concatenate(x) for x in zip(*parts))
            take = pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(k)).take(take) for k in ("item_id", "fh", "row")]
                + [pa.array(h.view(np.int64)), pa.array(c.astype(np.int32)), pa.array(n[who].astype(np.int64))],
                ["item_id", "fh", "row", "hash", "class", "n"])
    return src.mapInArrow(run, f"item_id {kind}, fh long, row long, hash long, class int, n long").select(
        "item_id", F.struct("fh", "row").alias("at"), "hash", "class", "n")


def bitmap(index: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bit for every hash of the index; never more than ``bits`` bits reach the driver."""
    place = F.pmod(F.col("hash"), F.lit(bits))
    parts = (index.select(place.alias("p")).groupBy(F.floor(F.col("p") / _BUCKET).alias("b"))
             .agg(F.bitmap_construct_agg((F.col("p") % _BUCKET)).alias("bits")))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.collect():
        at = r["b"] * (_BUCKET // 8)
        out[at:at + _BUCKET // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", containment: float = CONTAINMENT,
          shortest: int = 1) -> DataFrame:
    """doc_id, fh, row, item_id, n_item, n_shared, containment: documents that contain an item of at least
    ``shortest`` words."""
    index = item_index(items, item_id, item_text)
    index = stage(index.where((F.col("class") >= -1) | (F.col("class") >= short_class(shortest))), "items")
    mask = spark.sparkContext.broadcast(bitmap(index))
    every = spark.sparkContext.broadcast(bitmap(index.where((F.col("class") < 0) & (F.col("n") <= EXACT))))
    short = [k for k in range(1, WORDS) if index.where(F.col("class") == short_class(k)).take(1)]
    src = positioned(docs, doc_id=col(doc_id), text=col(text))
    kind = src.schema["doc_id"].dataType.simpleString()

    def passes(h: np.ndarray, of=mask) -> np.ndarray:
        p = h.view(np.int64) % BITS
        return of.value[p >> 3] >> (p & 7).astype(np.uint8) & 1 == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, most=CHUNK_CHARS):
            hashes, offsets = shingle_hashes(texts)
            counts = np.diff(offsets)
            seg, size = segments(counts)
            doc_of = np.repeat(np.arange(len(texts)), counts)
            owner = np.zeros(len(size), np.int64)
            owner[seg] = doc_of
            parts = []
            for c, u in enumerate(SIZES):
                mine = np.flatnonzero(size == c)
                number = np.full(len(size), -1)
                number[mine] = np.arange(len(mine))
                own = size[seg] == c
                g, least = sketch(hashes[own], number[seg[own]], len(mine), BINS * u)
                hit = passes(least)
                parts.append((owner[mine[g[hit]]], least[hit], np.full(hit.sum(), c)))
            found = np.zeros(len(texts), bool)
            found[np.concatenate([p[0] for p in parts])] = True
            # for the verification: all shingles that items may have, in any document those of short items
            own = np.flatnonzero(np.where(found[doc_of], passes(hashes), passes(hashes, every)))
            parts.append((doc_of[own], hashes[own], np.full(len(own), -1)))
            for k in short:
                seq, at = shingle_hashes(texts, k)
                own = np.flatnonzero(passes(seq, every))
                parts.append((np.repeat(np.arange(len(texts)), np.diff(at))[own], seq[own], np.full(len(own), short_class(k))))
            who, h, c = (np.concatenate(x) for x in zip(*parts))
            rows = np.unique(np.stack([who.astype(np.uint64), h, (c + WORDS).astype(np.uint64)]), axis=1)
            take = pa.array(rows[0].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(k)).take(take) for k in ("doc_id", "fh", "row")]
                + [pa.array(rows[1].view(np.int64)), pa.array(rows[2].astype(np.int32) - WORDS)],
                ["doc_id", "fh", "row", "hash", "class"])
    found = stage(src.mapInArrow(run, f"doc_id {kind}, fh long, row long, hash long, class int"), "found")
    both = found.join(index, ["hash", "class"])
    pair = ["fh", "row", "at"]
    # one row of hits for each pair: candidates have a common minimum, their class is not negative, or a short item
    return (both.groupBy(*pair).agg(
        F.max("class").alias("class"), F.first("doc_id").alias("doc_id"), F.first("item_id").alias("item_id"),
        F.max("n").alias("n_item"), F.count(F.when(F.col("class") < 0, 1)).alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
        .where(((F.col("class") >= 0) | (F.col("n_item") <= EXACT)) & (F.col("containment") >= containment))
        .select("doc_id", "fh", "row", "item_id", "n_item", "n_shared", "containment"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with all their columns."""
    docs = anchored(docs)
    gone = stage(leaks(spark, docs, table(spark, sf_dir, "benchmark")).select("fh", "row").distinct(), "leaks")
    return keep_positions(docs, gone, "left_anti")
