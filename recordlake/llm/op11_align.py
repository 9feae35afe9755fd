"""Operator 11, alignment of two tokenizations by whitespace-token anchors.

Each text is tokenised whole by a byte-level BPE (A) and by a SentencePiece model (B).
Where a token of A and a token of B end at the same byte and the next token of both
begins with a space, the text is split: what lies between two such anchors is a window,
a tuple of A ids and a tuple of B ids. A window's alignment (its groups and its links)
depends on these ids alone, so windows are aligned once and looked up by id tuples
afterwards. Groups are cut wherever both tokenisations end; links are pairs of an A and
a B token whose bytes overlap.

An id pair's count is the number of documents that hold it linked. Tasks cut their
documents into chunks and give for each chunk its distinct pairs with document counts;
only these go to the shuffle that adds them up, and each chunk fetches the counts of its
pairs once. So a pair that stands in nearly every document costs one row a chunk.

Defined cases: null and empty texts, and texts that either tokenizer changes, have no
tokens: zeros and an empty ``groups_sha256``; strings of special tokens are plain text;
repeated rows count as documents each; an empty table gives no rows; other columns are
ignored by ``aligned``. The memo is bounded (``MEMO_LINKS``) and lives as long as a task.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import anchored, chunks, col, stage

#: Characters of text in a chunk (a longer text is a chunk of its own).
CHUNK_CHARS = 1_000_000
#: Links and windows that a task's memo holds before it starts afresh.
MEMO_LINKS, MEMO_WINDOWS = 1_500_000, 250_000
SPACE = "▁"


def default_paths() -> tuple[str, str]:
    """Vocabulary files of the public tokenizers that are installed beside Python."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """Byte-level BPE writes each byte as a letter: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(rest)}


@dataclass
class Side:
    """One tokenizer: ``encode`` gives the ids of texts; ``bytes`` of each id."""
    encode: object
    bytes: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = [len(b) for b in self.bytes]
        self.length = np.array(self.lengths, np.int64)
        self.spaced = np.array([b[:1] == b" " for b in self.bytes])


def byte_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes of each token of a byte-level BPE file to its rank, if ids are ranks: bytes first, then merges in their
    order, as the fast encoder needs; else None."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    letters, vocab = byte_letters(), data["model"]["vocab"]
    added = {x["content"] for x in data.get("added_tokens", [])}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in data["model"]["merges"]]
    ranks = {bytes(letters[c] for c in p): i for p, i in vocab.items() if p not in added}
    plain = data.get("normalizer") is None and data["pre_tokenizer"] in (
        {"type": "ByteLevel", "add_prefix_space": k, "trim_offsets": o, "use_regex": True} for k in (True, False) for o in (True, False))
    in_order = [vocab[m] for m in merges] == list(range(256, 256 + len(merges)))
    return ranks if plain and in_order and sorted(ranks.values()) == list(range(len(ranks))) else None


# FIXED VALUE: how byte-level BPE cuts text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_bpe(path: str) -> Side:
    """Tokens of the file's tokenizer. Where its ids are merge ranks the same merges are made by a faster encoder;
    texts that it can't take (endless runs of white space) and other files go to the tokenizer itself."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    letters, ranks = byte_letters(), byte_ranks(path)
    table = []
    for i in range(t.get_vocab_size()):
        p = t.id_to_token(i) or ""
        table.append(bytes(letters[c] for c in p) if all(c in letters for c in p) else p.encode())

    def plainly(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in t.encode_batch([" " + x for x in texts], add_special_tokens=False)]
    if ranks is None:
        return Side(plainly, table)
    import tiktoken
    fast = tiktoken.Encoding("byte_bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        out = []
        for x in texts:
            try:
                out.append(fast.encode_ordinary(" " + x))
            except (KeyboardInterrupt, SystemExit, MemoryError):
                raise
            except BaseException:  # noqa: BLE001 - the word pattern gave up on a long run
                out += plainly([x])
        return out
    return Side(encode, table)


def piece_bpe(path: str) -> Side:
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(m.get_piece_size()):
        p = m.id_to_piece(i)
        table.append(bytes([int(p[3:5], 16)]) if m.is_byte(i) else
                     b"" if m.is_control(i) or m.is_unknown(i) else p.replace(SPACE, " ").encode())
    return Side(lambda texts: m.encode(texts, num_threads=1), table)


def spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from low to high (exclusive) of each pair, in order."""
    n = high - low
    return np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)


def links_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of tokens whose bytes overlap; both lists of ends reach the same last byte."""
    start_a = np.concatenate(([0], ends_a[:-1]))
    # B tokens from the one that holds a's first byte to the one that holds its last
    low, high = np.searchsorted(ends_b, start_a, "right"), np.searchsorted(ends_b, ends_a, "left") + 1
    return np.repeat(np.arange(len(ends_a)), high - low), spread(low, high)


class Windows:
    """Alignments of windows by their id tuples (packed as bytes, A ids, a mark and B ids): number of groups, their
    text, and link codes (A id in the high 32 bits, B id in the low ones)."""

    MARK = 0xFFFFFFFF

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        # an id as text with what may follow it: A's next id, B's first one, B's next id, the next group
        self.pieces = [f"{i}{c}" for c, side in ((",", a), ("|", a), (",", b), (";", b)) for i in range(len(side.bytes))]
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[int] = []
        self.text: list[str] = []
        self.links: list[bytes] = []
        self.held = 0

    def full(self) -> bool:
        return self.held > MEMO_LINKS or len(self.number) > MEMO_WINDOWS

    def find(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[int]:
        """Numbers of the windows that the cuts (starts, and the total at the end) make of tokens ``a`` and ``b``."""
        n = len(cut_a) - 1
        at = np.arange(n)
        packed = np.full(len(a) + len(b) + n, self.MARK, np.uint32)
        packed[np.arange(len(a)) + np.repeat(cut_b[:-1] + at, np.diff(cut_a))] = a
        packed[np.arange(len(b)) + np.repeat(cut_a[1:] + at + 1, np.diff(cut_b))] = b
        raw, edges = packed.tobytes(), (4 * (cut_a + cut_b + np.arange(n + 1))).tolist()
        keys = [raw[x:y] for x, y in zip(edges, edges[1:])]
        found = list(map(self.number.get, keys))
        new: dict[bytes, int] = {}
        for i, k in enumerate(found):
            if k is None:
                new.setdefault(keys[i], i)
        if new:
            pick = np.fromiter(new.values(), np.int64, len(new))
            self.add(list(new), *[x[spread(c[pick], c[pick + 1])] for x, c in ((a, cut_a), (b, cut_b))],
                     *[np.diff(c)[pick] for c in (cut_a, cut_b)])
            get = self.number.get
            found = [get(keys[i]) if k is None else k for i, k in enumerate(found)]
        return found

    def add(self, keys: list[bytes], a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> None:
        """Align new windows, all at once: they follow each other on one axis of bytes."""
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        la, lb = links_of(ends_a, ends_b)
        codes = ((a[la].astype(np.int64) << 32) | b[lb]).tobytes()
        window_a = np.repeat(np.arange(len(keys)), size_a)
        links = (8 * np.concatenate(([0], np.cumsum(np.bincount(window_a[la], minlength=len(keys)))))).tolist()
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        # tokens of a group side by side, A's first: an A token stands behind the B tokens of earlier groups
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + np.where(last_a, len(self.a.bytes), 0)
        order[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = (
            b + 2 * len(self.a.bytes) + np.where(last_b, len(self.b.bytes), 0))
        text = [self.pieces[i] for i in order.tolist()]
        edges = np.concatenate(([0], np.cumsum(size_a + size_b))).tolist()
        groups = np.bincount(window_a[last_a], minlength=len(keys)).tolist()
        for n, key in enumerate(keys):
            self.number[key] = len(self.text)
            self.text.append("".join(text[edges[n]:edges[n + 1]]))
            self.links.append(codes[links[n]:links[n + 1]])
        self.groups += groups
        self.held += len(la)


def whole_bytes(side: Side, ids: list[int], data: bytes) -> bool:
    table = side.bytes
    return b"".join([table[i] for i in ids]) == data


def align_texts(w: Windows, texts: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[tuple | None]:
    """For each text (number of A tokens, of B tokens, of groups, groups text, link codes with repeats); None if the
    tokens' bytes differ from the text's. All texts are one axis of bytes; a text's first token is space-marked, so
    where a text ends is an anchor like any other."""
    datas = [b" " + t.encode() for t in texts]
    good = [i for i, d in enumerate(datas) if whole_bytes(w.a, ids_a[i], d) and whole_bytes(w.b, ids_b[i], d)]
    out: list[tuple | None] = [None] * len(texts)
    if not good:
        return out
    a, b = (np.fromiter(chain.from_iterable([ids[i] for i in good]), np.int64) for ids in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(w.a.length[a]), np.cumsum(w.b.length[b])
    # ends before a space-marked token, on each side; anchors are those that both have
    before_a, before_b = ends_a[:-1][w.a.spaced[a[1:]]], ends_b[:-1][w.b.spaced[b[1:]]]
    anchors = np.intersect1d(before_a, before_b, assume_unique=True)
    cut_a, cut_b = (np.concatenate(([0], np.searchsorted(e, anchors, "right"), [len(x)])) for e, x in ((ends_a, a), (ends_b, b)))
    found = w.find(a, b, cut_a, cut_b)
    stops = np.searchsorted(anchors, np.cumsum([len(datas[i]) for i in good]), "left") + 1
    x = 0
    for i, y in zip(good, stops.tolist()):
        mine = found[x:y]
        out[i] = (len(ids_a[i]), len(ids_b[i]), sum([w.groups[n] for n in mine]), "".join([w.text[n] for n in mine])[:-1],
                  np.frombuffer(b"".join([w.links[n] for n in mine]), np.int64))
        x = y
    if w.full():
        w.clear()
    return out


#: One row per document (code null) and, for a chunk, its distinct pairs.
ROWS = pa.schema([("chunk", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                  ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                  ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])
SCHEMA = ("chunk string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, times array<int>")


def _chunk(name: str, batch: pa.RecordBatch, texts: list[str | None], w: Windows) -> pa.RecordBatch:
    full = [t for t in texts if t]
    aligned_texts = iter(align_texts(w, full, w.a.encode(full), w.b.encode(full)) if full else ())
    counts, shas, pairs, times = [], [], [], []
    for t in texts:
        got = (next(aligned_texts) if t else None) or (0, 0, 0, None, np.empty(0, np.int64))
        codes, k = np.unique(got[4], return_counts=True)
        counts.append((*got[:3], len(got[4])))
        shas.append("" if got[3] is None else hashlib.sha256(got[3].encode()).hexdigest())
        pairs.append(codes)
        times.append(k.astype(np.int32))
    sizes = np.cumsum([0, *[len(p) for p in pairs]])
    if sizes[-1] > 2 ** 31 - 1:
        raise ValueError("a chunk holds more pairs than one batch can")
    offsets = pa.array(sizes, pa.int32())
    return pa.record_batch([
        pa.array([name] * len(texts), pa.string()), batch.column(batch.schema.get_field_index("doc_id")),
        *[pa.array([c[k] for c in counts], pa.int64()) for k in range(4)], pa.array(shas, pa.string()),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pairs), pa.int64())),
        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times), pa.int32()))], schema=ROWS)


def _encode(paths: tuple[str, str] | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, w = TaskContext.get().partitionId(), None
        where = paths or default_paths()
        gc.disable()  # the memo is large and holds no cycles
        try:
            for n, (batch, texts) in enumerate(chunks(batches, most=CHUNK_CHARS)):
                w = w or Windows(byte_bpe(where[0]), piece_bpe(where[1]))
                yield _chunk(f"{part}.{n}", batch, texts, w)
        finally:
            gc.enable()
    return run


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each chunk with the number of its documents that hold them."""
    for batch in batches:
        flat = batch.column(1).flatten().to_numpy()
        names = np.array(batch.column(0).to_pylist(), object)
        sizes = np.diff(batch.column(1).offsets.to_numpy())
        for name in dict.fromkeys(names):
            codes, docs = np.unique(flat[np.repeat(names == name, sizes)], return_counts=True)
            yield pa.record_batch([pa.array([name] * len(codes), pa.string()), pa.array(codes, pa.int64()),
                                   pa.array(docs, pa.int64())], names=["chunk", "code", "docs"])


def _score(key, docs, counts):
    """n_best and count_sum of each document of a chunk, from the counts of the chunk's pairs."""
    codes = counts.column("code").to_numpy()
    order = np.argsort(codes)
    codes, n, best = codes[order], counts.column("n").to_numpy()[order], counts.column("best").to_numpy(zero_copy_only=False)[order]
    docs = docs.combine_chunks()
    pairs, times = docs.column("pairs").combine_chunks(), docs.column("times").combine_chunks()
    flat, k = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    at = np.searchsorted(codes, flat)
    ends = np.cumsum(np.diff(pairs.offsets.to_numpy()))
    total, right = (np.concatenate(([0], np.cumsum(v))) for v in (n[at] * k, best[at] * k)) if len(flat) else (np.zeros(1, int),) * 2
    starts = np.concatenate(([0], ends[:-1]))
    out = docs.drop_columns(["chunk", "pairs", "times"])
    return out.append_column("n_best", pa.array(right[ends] - right[starts], pa.int64())).append_column(
        "count_sum", pa.array(total[ends] - total[starts], pa.int64()))


def encoded(docs: DataFrame, paths: tuple[str, str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its token numbers, groups digest and distinct linked pairs (A id in the high 32 bits, B id in the
    low ones) with how often each is linked; staged."""
    docs = anchored(docs)
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    return stage(rows.mapInArrow(_encode(paths), SCHEMA), "aligned")


def pair_counts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk, code, docs) and (code, n, best) of the rows of ``encoded``: documents that hold a pair, in the
    chunk and in all, and whether the pair's count is the highest of its A id."""
    some = stage(rows.select("chunk", "pairs").mapInArrow(_pairs, "chunk string, code long, docs long"), "pairs")
    total = stage(some.groupBy("code").agg(F.sum("docs").alias("n")), "counts")
    a = F.shiftright("code", 32)
    highest = total.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))
    total = total.withColumn("a", a).join(highest, "a")
    return some, total.select("code", "n", (F.col("n") == F.col("highest")).alias("best"))


def aligned(spark: SparkSession, docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum: one row per row of ``docs``."""
    rows = encoded(docs, paths)
    some, total = pair_counts(rows)
    fetched = some.select("chunk", "code").distinct().join(total, "code")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return rows.groupBy("chunk").cogroup(fetched.groupBy("chunk")).applyInArrow(_score, schema)
