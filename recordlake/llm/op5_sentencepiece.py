"""Operator 5, SentencePiece encoding and decoding by suffix-array matching.

A text gets the model's dummy prefix, its spaces become the space mark, and it falls into
units that no piece of the vocabulary crosses: a run of space marks with what follows
up to the next mark or line break. The distinct new units of a batch are concatenated and
indexed by a suffix array; every piece is binary-searched for its occurrences; the
resulting edges are sorted by position and relaxed from left to right. For byte-pair
models one edge into each position is right: the last piece of the prefix's encoding.
An edge is that one if byte-pair merging would keep its piece apart from the last piece
before it, which depends on the two pieces alone (``stays_apart``). So the result is that
of merging by the definition, not just some cheap segmentation. Runs of space marks, whose
merges all have one rank, are merged by a closed rule. Characters outside the vocabulary
become bytes.

Decoding joins the pieces' bytes and drops the dummy prefix.

Defined cases: null gives null ids and null text; an empty text gives no ids; a text that
holds the space mark itself decodes to a space there (the model can't tell them apart);
other columns are ignored. Texts are whole, whatever their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm import pieces
from recordlake.llm.common import WORKER, chunks, col, ship, whole
from recordlake.llm.pieces import SPACE, Matcher, Vocabulary
from recordlake.llm.shingles import mix

#: Units whose encodings a worker remembers (by 64-bit hashes); beyond, it starts anew.
#: Units that a worker remembers (about 40 bytes each); characters that it encodes at once.
REMEMBERED, CHUNK_CHARS = 1_000_000, 500_000
_PAIRS = 1 << 21


def stays_apart(v: Vocabulary, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging the text of pieces a and b by the definition gives a and b.

    Undoes the merges inside both, latest first, and looks whether the parts that meet at
    the boundary would have merged before what was undone last.
    """
    a, b = a.astype(np.int64), b.astype(np.int64)
    ok = np.ones(len(a), bool)
    limit = np.full(len(a), np.iinfo(np.int64).max)
    todo = np.arange(len(a))
    n = len(v.text)
    while len(todo):
        x, y = a[todo], b[todo]
        key = x * n + y
        at = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
        joins = (v.pair_keys[at] == key) & (v.pair_rank[at] < limit[todo])
        ok[todo[joins]] = False
        rx, ry = v.rank[x], v.rank[y]
        todo_next = ~joins & ~((rx < 0) & (ry < 0))
        undo_a = rx > ry
        limit[todo] = np.where(undo_a, rx, ry + 1)
        a[todo] = np.where(undo_a, v.right[x], x)
        b[todo] = np.where(undo_a, y, v.left[y])
        todo = todo[todo_next]
    return ok


def space_run(n: int, lengths: set[int]) -> list[int]:
    """Lengths of the pieces of a run of n space marks: the leftmost pair that makes a
    piece merges first."""
    out: list[int] = []
    rest = n
    while True:
        if len(out) > 1 and out[-2] + out[-1] in lengths:
            last = out.pop()
            out[-1] += last
        elif rest and out and out[-1] + 1 in lengths:
            out[-1] += 1
            rest -= 1
        elif rest:
            out.append(1)
            rest -= 1
        else:
            return out


class Encoder:
    """Encodes units, remembering them."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.matcher = Matcher(vocabulary)
        self.pair_key = np.full(_PAIRS, -1, np.int64)
        self.pair_ok = np.zeros(_PAIRS, bool)
        self.space = vocabulary.text.index(SPACE)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)   # hashes of remembered units, sorted
        self.place = np.zeros(0, np.int64)    # their rows in ends
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * len(self.v.text) + b
        slot = (key * 0x9E3779B1 >> 11) & (_PAIRS - 1)
        miss = np.flatnonzero(self.pair_key[slot] != key)
        out = self.pair_ok[slot]
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            ok = stays_apart(self.v, new // len(self.v.text), new % len(self.v.text))
            out[miss] = ok[back]
            at = slot[miss]
            self.pair_key[at] = key[miss]
            self.pair_ok[at] = self.pair_key[at] == key[miss]  # the last of equal slots has won
            self.pair_ok[at] &= out[miss]
        return out

    def relax(self, units: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of units with at most one space mark, which is their first character,
        and the offsets of each unit's."""
        text = "\n".join([*units, ""])
        codes = self.matcher.codes(text)
        starts, unit_of = pieces.unit_starts(units)
        start, piece = self.matcher.edges(codes)
        good = self.v.reachable[piece]
        start, piece = start[good], piece[good].astype(np.int32)
        unknown = np.flatnonzero(codes == 0)
        ends = starts + np.diff(np.append(starts, len(codes))) - 1
        unknown = unknown[~np.isin(unknown, ends)]
        start = np.concatenate([start, unknown])
        piece = np.concatenate([piece, np.full(len(unknown), -1, np.int32)])
        length = np.where(piece < 0, 1, self.matcher.lengths[piece])
        order, bounds = pieces.by_end(start, length, unit_of[start])
        start, piece, length = start[order], piece[order], length[order]
        last = np.full(len(codes) + 1, -1, np.int32)
        step = np.zeros(len(codes) + 1, np.int8)
        for i, j in zip(bounds[:-1], bounds[1:]):
            s, p = start[i:j], piece[i:j]
            prev = last[s]
            ok = (prev < 0) | (p < 0)
            ask = np.flatnonzero(~ok)
            ok[ask] = self.apart(prev[ask], p[ask])
            e = s[ok] + length[i]
            last[e], step[e] = p[ok], length[i]
        # walk back from the ends of all units at once
        at, unit, rows = ends.copy(), np.arange(len(units)), []
        while len(at):
            going = at > starts[unit]
            at, unit = at[going], unit[going]
            rows.append((unit, last[at], at - 1))
            at = at - step[at]
        unit, piece, place = (np.concatenate(x[::-1]) for x in zip(*rows))
        order = np.argsort(unit, kind="stable")
        unit, piece, place = unit[order], piece[order], place[order]
        known = piece >= 0
        token = np.where(known, self.v.ids[piece], 0)
        if known.all():
            return token.astype(np.int32), np.searchsorted(unit, np.arange(len(units) + 1))
        spelt = [[t] if k else self.v.byte_ids[list(text[p].encode("utf-8", "surrogatepass"))].tolist()
                 for t, k, p in zip(token.tolist(), known.tolist(), place.tolist())]
        many = np.fromiter(map(len, spelt), np.int64, len(spelt))
        return (np.fromiter((x for t in spelt for x in t), np.int32, many.sum()),
                np.searchsorted(np.repeat(unit, many), np.arange(len(units) + 1)))

    def spell(self, units: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of any units, and the offsets of each unit's."""
        rests = [SPACE + u.lstrip(SPACE) if u.startswith(SPACE * 2) else u for u in units]
        ids, at = self.relax(rests)
        runs = [i for i, (u, r) in enumerate(zip(units, rests)) if len(u) > len(r)]
        if not runs:
            return ids, at
        parts = np.split(ids, at[1:-1])
        for i in runs:
            n = len(units[i]) - len(rests[i]) + 1
            bare = parts[i][0] == self.v.ids[self.space]
            mine = [self.v.run_ids[k] for k in space_run(n if bare else n - 1, set(self.v.run_ids))]
            parts[i] = np.concatenate([np.array(mine, np.int32), parts[i][int(bare):]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, and the offsets of each text's."""
        data, sizes = spaced(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        starts, first = units_of(data, sizes)
        length = np.diff(np.append(starts, len(data)))
        unit, at, back = np.unique(hashed(data, starts, length), return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.clear()
        seen = np.searchsorted(self.known, unit)
        new = np.flatnonzero(self.known[np.minimum(seen, len(self.known) - 1)] != unit if len(self.known)
                             else np.ones(len(unit), bool))
        if len(new):
            raw, lo, n = data.tobytes(), starts[at[new]].tolist(), length[at[new]].tolist()
            ids, ends = self.spell([raw[i:i + k].decode("utf-8", "surrogatepass").replace(" ", SPACE)
                                    for i, k in zip(lo, n)])
            fresh = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(new))
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + ends[1:]])
            self.known = np.insert(self.known, seen[new], unit[new])
            self.place = np.insert(self.place, seen[new], fresh)
            seen = np.searchsorted(self.known, unit)
        k = self.place[seen][back]
        n = self.ends[k + 1] - self.ends[k]
        out = np.cumsum(n)
        ids = self.ids[np.repeat(self.ends[k] - (out - n), n) + np.arange(out[-1])]
        return ids, np.concatenate([[0], out])[np.append(first, len(starts))]


def spaced(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts, each that isn't empty with the dummy prefix (a space; the space mark
    itself is a space to the model), and the bytes of each."""
    raw = [(" " + t.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))


def units_of(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units start: at a text's start, a space after none, a line break and after one;
    and each text's first unit."""
    space, line = data == 32, data == 10
    start = line.copy()
    start[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    begin = np.cumsum(sizes) - sizes
    start[begin[sizes > 0]] = True
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, begin)


def hashed(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each unit's bytes."""
    power = np.full(int(length.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = mix(np.multiply.accumulate(power))
    place = np.arange(len(data)) - np.repeat(starts, length)
    value = (data.astype(np.uint64) + np.uint64(1)) * power[place]
    return mix(np.add.reduceat(value, starts) + length.astype(np.uint64))


class Decoder:
    def __init__(self, v: Vocabulary):
        self.bytes = [b""] * v.size
        for p, i in zip(v.text, v.ids):
            self.bytes[i] = p.replace(SPACE, " ").encode("utf-8")
        for n, i in v.run_ids.items():
            self.bytes[i] = b" " * n
        for b, i in enumerate(v.byte_ids):
            if not self.bytes[i]:
                self.bytes[i] = bytes([b])

    def decode(self, ids: Sequence[int]) -> str:
        out = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if out[:1] == " " else out


def _tools(vocabulary) -> tuple[Encoder, Decoder]:
    """This worker's encoder and decoder for the broadcast vocabulary."""
    v = vocabulary.value
    key = (v.size, len(v.text), hash(tuple(v.text)))
    if key not in WORKER:
        WORKER.clear()
        WORKER[key] = Encoder(v), Decoder(v)
    return WORKER[key]


def encode(spark: SparkSession, df: DataFrame, text: str = "text", path: str | None = None,
           ids: bool = True, check: bool = False, without: Sequence[str] = ()) -> DataFrame:
    """``df`` with n_tokens and, as asked for, ids (array<int>); ids_crc32 (of the ids as
    little-endian 32-bit numbers) and round_trip (whether decoding them gives the text back). Columns
    ``without`` are left out: a text that isn't returned is sent to Python once and not back."""
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(pieces.load(path))
    kept = df.drop(*without)
    src = df.select(whole(kept).alias("d"), col(text).alias("t"))
    new = {"n_tokens": "long"} | ({"ids": "array<int>"} if ids else {})
    new |= {"ids_crc32": "long", "round_trip": "boolean"} if check else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(vocabulary)
        for batch, texts in chunks(batches, "t", CHUNK_CHARS):
            tokens, at = encoder.encode(texts)
            null = np.array([t is None for t in texts])
            out = [pa.array(np.diff(at), pa.int64(), mask=null)]
            if ids:
                out.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(tokens), mask=pa.array(null)))
            if check:
                raw, flat, at = tokens.astype("<i4"), tokens.tolist(), at.tolist()
                crc = [zlib.crc32(raw[i:j].tobytes()) for i, j in zip(at, at[1:])]
                same = [decoder.decode(flat[i:j]) == (t or "") for t, i, j in zip(texts, at, at[1:])]
                out += [pa.array(crc, pa.int64(), mask=null), pa.array(same, pa.bool_(), mask=null)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("d")), *out], ["d", *new])
            del batch, texts  # not held while the next are read
    more = ", ".join(f"{k} {v}" for k, v in new.items())
    found = src.mapInArrow(run, f"d {src.schema['d'].dataType.simpleString()}, {more}")
    return found.select(*[F.col("d")[c].alias(c) for c in kept.columns if c.lower() not in new], *new)


def decode(spark: SparkSession, df: DataFrame, ids: str = "ids", out: str = "decoded",
           path: str | None = None) -> DataFrame:
    """``df`` with the text of its ids."""
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(pieces.load(path))
    src = df.select(whole(df).alias("d"), col(ids).alias("i"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _tools(vocabulary)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("i")).to_pylist()
            texts = [None if x is None else decoder.decode(x) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("d")), pa.array(texts, pa.string())], ["d", "t"])
    found = src.mapInArrow(run, f"d {src.schema['d'].dataType.simpleString()}, t string")
    return found.select(*[F.col("d")[c].alias(c) for c in df.columns if c.lower() != out.lower()], F.col("t").alias(out))
