"""Operator 3, line deduplication by a segment-partition edit join.

Lines within an edit distance of ``DISTANCE`` are near copies. A line is split into
``DISTANCE + 1`` even segments; of two lines that are that close, the shorter's segments
include one that occurs in the other, near its own place (pigeonhole). Every line indexes
its segments under (length, number, content) and probes the substrings of the multi-match
aware ranges for each length that is not longer and at most ``DISTANCE`` shorter (what it
indexes itself isn't dealt twice). Keys are dealt to buckets as blocks of packed rows; a task sorts a
bucket's rows and gives each pair that meets there once. Pairs
that meet, and whose character pairs' parities don't prove them farther apart, are verified with a banded bit-parallel automaton: bits are the diagonals of the
band, one word for each number of errors, all pairs of a batch at a time. Rows of a key that more than
``TOGETHER`` lines have are joined by Spark, which can split such a key.

Equal lines are one node, combined before any shuffle. Classes are the connected
components of the links; of each class the first line by (doc_id, file hash, row, line
number) stays and the others go.

Defined cases: a null text has no lines; blank lines stay and are never compared; lines
shorter than ``SHORTEST`` characters have exact copies only; other columns are ignored;
repeated rows are copies of each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.common import anchored, chunks, col, positioned, small, stage
from recordlake.llm.op2_probminhash import components
from recordlake.llm.op4_containment import BITS, bitmap
from recordlake.llm.shingles import mix

DISTANCE = 2
SHORTEST = 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Characters of text that a task signs at once; buckets that keys are dealt to, as a power of two.
CHUNK_CHARS, BUCKET_BITS = 1_000_000, 10
#: Rows of one key that one task compares; of keys of more, Spark joins the rows.
TOGETHER = 2_000
ROW = np.dtype([("key", np.uint64), ("line", np.uint64), ("parity", np.uint64), ("indexed", bool)])
_MET = ["x", "y", "key", "parity", "indexed"]
_PAIRS = 1 << 20
_BLANK = " \t\n\x0b\f\r"  # what a blank line consists of


def segments(length: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the segments of lines of each length: (lines, segments)."""
    k = distance + 1
    size = (length[:, None] + np.arange(k)) // k
    return np.cumsum(size, axis=1) - size, size


def signatures(length: np.ndarray, distance: int, index: bool, own: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
    """(line, indexed length, segment, start, size) of what lines index, or of what they probe (without
    ``own``: but what they index themselves)."""
    line = np.arange(len(length))
    for shorter in range(1 if index else distance + 1):
        target = length - shorter
        start, size = segments(target, distance)
        for i in range(distance + 1):
            s, z = start[:, i], size[:, i]
            if index:
                yield line, target, np.full(len(line), i), s, z
                continue
            low = np.maximum.reduce([np.zeros_like(s), s - i, s + shorter - (distance - i)])
            high = np.minimum.reduce([length - z, s + i, s + shorter + (distance - i)])
            for step in range(2 * distance + 1):
                ok = low + step <= high
                if shorter == 0 and not own:
                    ok &= low + step != s
                if ok.any():
                    yield line[ok], target[ok], np.full(ok.sum(), i), (low + step)[ok], z[ok]


def codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all lines, and the start and length of each."""
    data = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    return data, np.cumsum(length) - length, length


def prefixes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and factors that give a hash of any run of ``data``: (sum[end] - sum[start]) * factor[start]."""
    power = np.full(len(data) + 1, _BASE, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(len(data) + 1, _INVERSE, np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(data.astype(np.uint64) + np.uint64(1)) * power[:-1])]), back


def line_ids(begin: np.ndarray, length: np.ndarray, prefix: np.ndarray, back: np.ndarray) -> np.ndarray:
    """64 bits of each whole line."""
    return mix((prefix[begin + length] - prefix[begin]) * back[begin] ^ mix(length.astype(np.uint64) + np.uint64(_BASE)))


def keys(lines: list[str], distance: int, index: bool) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of all signatures of ``lines``."""
    data, begin, length = codes(lines)
    return keys_of(begin, length, *prefixes(data), distance, index)


def keys_of(begin: np.ndarray, length: np.ndarray, prefix: np.ndarray, back: np.ndarray, distance: int, index: bool,
            own: bool = True) -> tuple[np.ndarray, np.ndarray]:
    who, out = [], []
    for line, target, i, start, size in signatures(length, distance, index, own):
        s = begin[line] + start
        content = (prefix[s + size] - prefix[s]) * back[s]
        out.append(mix(content ^ mix((target * (distance + 1) + i).astype(np.uint64))))
        who.append(line)
    return np.concatenate(who), np.concatenate(out)


def parities(lines: list[str]) -> np.ndarray:
    """64 bits of each line: the parities of its hashed character pairs. One edit changes at
    most four of them, so lines within d edits differ in at most 4d bits."""
    return parities_of(*codes(lines))


def parities_of(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    wide = data.astype(np.uint64)
    pair = wide[:-1] * np.uint64(_BASE) + wide[1:] * np.uint64(_INVERSE)
    bit = np.append(np.uint64(1) << (pair >> np.uint64(58)), np.uint64(0))
    bit[begin + length - 1] = 0  # a pair that reaches into the next line
    return np.bitwise_xor.reduceat(bit, begin)


def long_lines(texts: list[str | None], least: int) -> list[str]:
    """The different lines of at least ``least`` characters that aren't blank."""
    return list(dict.fromkeys(x for t in texts if t for x in t.split("\n") if len(x) >= least and x.strip(_BLANK)))


def alike(key: np.ndarray, line: np.ndarray, parity: np.ndarray, indexed: np.ndarray, most: int,
          together: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of different lines (smaller and larger id, each pair once) that have a key in common, one of them in its
    index, and whose parities differ in at most ``most`` bits; and the places of the rows whose key has more
    than ``together`` rows, which aren't compared."""
    order = np.lexsort((~indexed, line, key))
    k, x = key[order], line[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (x[1:] != x[:-1])  # of a line's equal keys the one that it indexes
    order = order[fresh]
    order = order[np.lexsort((~indexed[order], key[order]))]
    k = key[order]
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    size = np.diff(np.append(at, len(k)))
    large = np.repeat(size > together, size)
    end = np.repeat(at + size, size)
    first = np.flatnonzero(indexed[order] & ~large & (end - np.arange(len(k)) > 1))
    x, p = line[order], parity[order]
    todo, found = (end[first] - first - 1), np.zeros((2, 0), np.int64)
    cuts = np.searchsorted(np.cumsum(todo), np.arange(_PAIRS, todo.sum() + 1, _PAIRS))
    for i, j in zip([0, *cuts + 1], [*cuts + 1, len(first)]):
        n = todo[i:j]
        a = np.repeat(first[i:j], n)
        b = a + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ok = (np.bitwise_count(p[a] ^ p[b]) <= most) & (x[a] != x[b])
        two = np.stack([np.minimum(x[a[ok]], x[b[ok]]), np.maximum(x[a[ok]], x[b[ok]])])
        found = np.unique(np.concatenate([found, two], axis=1), axis=1)
    return found[0], found[1], order[large]


def within(pairs: list[tuple[str, str]], distance: int) -> np.ndarray:
    """Whether the edit distance of each pair is at most ``distance``."""
    n = len(pairs)
    if not n:
        return np.zeros(0, bool)
    pad = "\0" * distance
    la = np.fromiter((len(a) for a, _ in pairs), np.int64, n)
    lb = np.fromiter((len(b) for _, b in pairs), np.int64, n)
    # 0 is no character here: codes are one higher
    a = np.frombuffer("".join(pad + x + pad for x, _ in pairs).encode("utf-32-le", "surrogatepass"), np.uint32) + 1
    b = np.frombuffer("".join(x for _, x in pairs).encode("utf-32-le", "surrogatepass"), np.uint32) + 1
    a0 = np.cumsum(la + 2 * distance) - (la + 2 * distance)
    b0 = np.cumsum(lb) - lb
    a = a.copy()
    for k in range(distance):  # padding matches nothing
        a[a0 + k] = 0
        a[a0 + distance + la + k] = 0
    width = 2 * distance + 1
    full = (1 << width) - 1
    state = [np.full(n, ((1 << (e + 1)) - 1) << distance & full, np.int64) for e in range(distance + 1)]
    out = np.zeros(n, bool)
    alive = np.flatnonzero(np.abs(la - lb) <= distance)
    state = [s[alive] for s in state]
    j = 0
    while len(alive):
        done = lb[alive] == j
        if done.any():
            end = (la - lb)[alive[done]] + distance
            out[alive[done]] = (state[distance][done] >> end) & 1 == 1
        going = ~done & (state[distance] > 0)
        alive, state = alive[going], [s[going] for s in state]
        if not len(alive):
            break
        c = b[b0[alive] + j]
        at = a0[alive] + j
        match = np.zeros(len(alive), np.int64)
        for k in range(width):  # diagonal k - distance: character j + k - distance of a
            match |= (a[np.minimum(at + k, len(a) - 1)] == c).astype(np.int64) << k
        new = [state[0] & match]
        for e in range(1, distance + 1):
            new.append(((state[e] & match) | state[e - 1] | (state[e - 1] >> 1) | (new[e - 1] << 1)) & full)
        state = new
        j += 1
    return out


def lines_of(docs: DataFrame, text: str, **more) -> DataFrame:
    """fh, row, pos, line, node (128-bit digest), id (64 bits of another): every line that isn't blank."""
    src = positioned(docs, text=col(text), **more)
    out = src.select(*more, "fh", "row", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return out.where(F.col("line").rlike(r"\S")).withColumns(
        {"node": F.unhex(F.md5(F.col("line").cast("binary"))), "id": F.xxhash64("line")})


def near_pairs(docs: DataFrame, text: str = "text", distance: int = DISTANCE, shortest: int = SHORTEST,
               together: int = TOGETHER) -> DataFrame:
    """a, b: nodes of different lines within the distance."""
    least = max(shortest, distance + 1)
    src = positioned(docs, text=col(text)).select("text")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches, most=CHUNK_CHARS):
            mine = long_lines(texts, least)
            if not mine:
                continue
            data, begin, length = codes(mine)
            sums = prefixes(data)
            ids, parity = line_ids(begin, length, *sums), parities_of(data, begin, length)
            parts = [keys_of(begin, length, *sums, distance, index, own=False) for index in (True, False)]
            who, key = (np.concatenate(x) for x in zip(*parts))
            rows = np.empty(len(who), ROW)
            rows["key"], rows["line"], rows["parity"] = key, ids[who], parity[who]
            rows["indexed"] = np.arange(len(who)) < len(parts[0][0])
            bucket = (key >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            blocks = [x.tobytes() for x in np.split(rows[order], at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[order[at]]), pa.array(blocks, pa.binary())], ["bucket", "rows"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in by_bucket(batches):
            rows = np.frombuffer(b"".join(blocks), ROW)
            line, parity = rows["line"].view(np.int64), rows["parity"]
            x, y, rest = alike(rows["key"], line, parity, rows["indexed"], 4 * distance, together)
            none = pa.nulls(len(x), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), none, none, pa.nulls(len(x), pa.bool_())], _MET)
            for i in range(0, len(rest), _PAIRS):
                r = rows[rest[i:i + _PAIRS]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["line"].view(np.int64)), pa.nulls(len(r), pa.int64()), pa.array(r["key"].view(np.int64)),
                     pa.array(r["parity"].view(np.int64)), pa.array(r["indexed"])], _MET)
    blocks = src.mapInArrow(sign, "bucket int, rows binary").repartition("bucket").sortWithinPartitions("bucket")
    met = stage(blocks.mapInArrow(meet, "x long, y long, key long, parity long, indexed boolean"), "met")
    pairs = met.where("key is null").select("x", "y")
    # keys of more rows than a task compares: Spark splits a hot key of its own join
    rest = met.where("key is not null")
    other = rest.select("key", F.col("x").alias("y"), F.col("parity").alias("py"), F.col("indexed").alias("also"))
    pairs = pairs.unionByName(rest.where("indexed").select("key", "x", "parity").join(other, "key").where(
        (F.col("x") != F.col("y")) & (~F.col("also") | (F.col("x") < F.col("y")))
        & (F.bit_count(F.col("parity").bitwiseXOR(F.col("py"))) <= 4 * distance))
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
    pairs = stage(pairs.distinct(), "candidates")
    wanted = stage(pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "wanted")
    mask = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.col("id").alias("hash"))))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches, most=CHUNK_CHARS):
            mine = long_lines(texts, least)
            if not mine:
                continue
            data, begin, length = codes(mine)
            ids = line_ids(begin, length, *prefixes(data)).view(np.int64)
            place = ids % BITS
            take = np.flatnonzero(mask.value[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[take]), pa.array([mine[i] for i in take.tolist()], pa.string())], ["id", "line"])
    texts = src.mapInArrow(fetch, "id long, line string").join(small(wanted), "id", "left_semi")
    texts = texts.withColumn("node", F.unhex(F.md5(F.col("line").cast("binary"))))
    texts = stage(texts.groupBy("node").agg(F.first("id").alias("id"), F.first("line").alias("line")), "lines")
    both = (pairs.join(texts.select(F.col("id").alias("x"), F.col("node").alias("a"), F.col("line").alias("text")), "x")
            .join(texts.select(F.col("id").alias("y"), F.col("node").alias("b"), F.col("line").alias("other")), "y")
            .select("a", "b", "text", "other").where("a != b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, left in chunks(batches):
            right = batch.column(batch.schema.get_field_index("other")).to_pylist()
            ok = pa.array(np.flatnonzero(within(list(zip(left, right)), distance)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)).take(ok) for c in ("a", "b")], ["a", "b"])
    return both.mapInArrow(verify, "a binary, b binary")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The blocks of each bucket, whose rows follow each other."""
    now, mine = None, []
    for batch in batches:
        for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != now and mine:
                yield mine
                mine = []
            now = bucket
            mine.append(block.as_py())
    if mine:
        yield mine


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE,
                shortest: int = SHORTEST) -> DataFrame:
    """doc_id, fh, row, n_lines, n_copies (lines that go as exact copies), n_near (that go as near
    copies), n_links (of the document's lines to different lines), clean (the text without
    them): one row per row of ``docs``."""
    docs = anchored(docs)
    found = stage(near_pairs(docs, text, distance, shortest), "near")
    comps = components(found) if found.take(1) else found.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    place = F.struct("doc_id", "fh", "row", "pos")
    rows = lines_of(docs, text, doc_id=col(doc_id)).select("doc_id", "fh", "row", "pos", "node")
    nodes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min(place).alias("own"))
    degree = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    nodes = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    nodes = stage(nodes.join(degree, "node", "left").where("n > 1 or links > 0"), "nodes")
    first = nodes.groupBy("comp").agg(F.min("own").alias("first"))
    nodes = stage(nodes.join(first, "comp").select(
        "node", "own", "first", F.coalesce("links", F.lit(0)).alias("links")), "classes")
    # both by merging, as large inputs need it, so that small ones show how shuffles grow
    lines = rows.join(nodes.hint("merge"), "node")
    one = lines.groupBy("fh", "row").agg(
        F.sort_array(F.collect_list(F.when(place != F.col("first"), F.col("pos")))).alias("gone"),
        F.count(F.when(place != F.col("own"), 1)).alias("n_copies"),
        F.count(F.when((place == F.col("own")) & (place != F.col("first")), 1)).alias("n_near"),
        F.sum("links").alias("n_links"))
    body = positioned(docs, doc_id=col(doc_id), text=col(text)).join(stage(one, "gone").hint("merge"), ["fh", "row"], "left")
    lines = F.split("text", "\n", -1)
    stays = F.when(F.size("gone") > 0, F.array_join(F.filter(
        lines, lambda x, i: ~F.array_contains("gone", i)), "\n")).otherwise(F.col("text"))
    return body.select("doc_id", "fh", "row", F.coalesce(F.size(F.filter(lines, lambda x: x.rlike(r"\S"))), F.lit(0)).cast("long").alias("n_lines"),
                       *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_copies", "n_near", "n_links")],
                       stays.alias("clean"))
