"""Operator 1, language identification by segmentation-marginalised unigrams.

Each language is a unigram model over the pieces of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, computed by a forward
pass over the lattice of piece occurrences; a text's log-probability is the sum over
its words (maximal runs of letters, lower-cased, with the word-start mark). Piece
probabilities are fitted by expectation-maximisation (forward-backward) on a bounded
sample: about ``TRAIN_DOCS`` labelled training documents a language, chosen by a hash of
their position. Every word of every text is scored.

Documents whose crc32(doc_id as text) leaves remainder 1 by 3 are held out of training.

Defined cases: a text that is null or has no letter gets ``und`` and score 0; so does every
text if there is no labelled training document; a null label doesn't train; a null
doc_id isn't held out; ties go to the first language in alphabetical order; characters
outside the vocabulary have one small probability in every language.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm import pieces
from recordlake.llm.common import WORKER, anchored, chunks, col, keep_positions, positioned, stage
from recordlake.llm.op5_sentencepiece import hashed
from recordlake.llm.pieces import SPACE, Matcher, Vocabulary

TRAIN_DOCS = 300
ROUNDS = 3
SMOOTHING = 0.05
UNKNOWN = np.log(1e-7)
#: Bytes of words and scores that a task remembers; characters that it scores at once.
REMEMBERED, CHUNK_CHARS = 32 << 20, 250_000
UNDETERMINED = "und"

_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def words(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all lower-cased texts, the start and length of each word, and the offset
    of each text's first word."""
    raw = [((t or "").lower() + "\n").encode("utf-32-le", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint32)
    edge = np.diff(letters()[data].view(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum([len(r) // 4 for r in raw])
    return data, starts, stops - starts, np.concatenate([[0], np.searchsorted(starts, ends)])


def word_keys(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    total = int(length.sum())
    inner = np.cumsum(length) - length
    at = np.repeat(starts - inner, length) + np.arange(total)
    return hashed(data[at], inner, length)


class Lattice:
    """All segmentations of words, as edges sorted by position."""

    def __init__(self, matcher: Matcher, units: Sequence[str]):
        marked = [SPACE + u for u in units]
        codes = matcher.codes("\n".join([*marked, ""]))
        self.starts, unit_of = pieces.unit_starts(marked)
        start, piece = matcher.edges(codes)
        self.ends = self.starts + np.diff(np.append(self.starts, len(codes))) - 1
        unknown = np.flatnonzero(codes == 0)
        unknown = unknown[~np.isin(unknown, self.ends)]
        start = np.concatenate([start, unknown])
        piece = np.concatenate([piece, np.full(len(unknown), len(matcher.lengths))])
        length = np.append(matcher.lengths, 1)[piece]
        order, bounds = pieces.by_end(start, length, unit_of[start])
        self.start, self.piece, self.stop = start[order], piece[order], (start + length)[order]
        self.runs = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        self.size = len(codes) + 1

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        """Log-probability of every prefix, for each column of ``log_p``."""
        out = np.full((self.size, log_p.shape[1]), -np.inf)
        out[self.starts] = 0
        with np.errstate(invalid="ignore"):
            for i, j in self.runs:
                s, e = self.start[i:j], self.stop[i:j]
                out[e] = np.logaddexp(out[e], out[s] + log_p[self.piece[i:j]])
        return out

    def expected(self, log_p: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected occurrences of every piece over all segmentations; one column."""
        up = self.forward(log_p)[:, 0]
        down = np.full(self.size, -np.inf)
        down[self.ends] = 0
        p = log_p[:, 0][self.piece]
        for i, j in reversed(self.runs):
            s, e = self.start[i:j], self.stop[i:j]
            down[s] = np.logaddexp(down[s], down[e] + p[i:j])
        unit = np.searchsorted(self.starts, self.start, side="right") - 1
        share = np.exp(up[self.start] + p + down[self.stop] - up[self.ends][unit])
        return np.bincount(self.piece, share * count[unit], len(log_p))


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # (pieces + 1, languages); the last row: an unknown character
    vocabulary: Vocabulary


def fit(vocabulary: Vocabulary, counts: dict[str, dict[str, int]]) -> Model:
    """Piece probabilities of each language from its words' counts."""
    matcher = Matcher(vocabulary)
    n = len(vocabulary.text)
    names = sorted(counts)
    out = np.full((n + 1, len(names)), -np.log(n))
    out[n] = UNKNOWN
    for k, name in enumerate(names):
        units = sorted(counts[name])
        lattice = Lattice(matcher, units)
        weight = np.array([counts[name][u] for u in units], float)
        for _ in range(ROUNDS):
            c = lattice.expected(out[:, k:k + 1], weight)[:n] + SMOOTHING
            out[:n, k] = np.log(c / c.sum())
    return Model(names, out, vocabulary)


def train(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          path: str | None = None, train_docs: int = TRAIN_DOCS) -> Model:
    """A model of the labelled documents that aren't held out. Only word counts of the
    bounded sample reach the driver."""
    rows = positioned(docs, id=col(doc_id), text=col(text), lang=col(lang).cast("string"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, 0)), pieces.load(path))
    draw = F.shiftrightunsigned(F.xxhash64("fh", "row"), 11) / float(2 ** 53)
    share = F.create_map(*[x for name, n in sizes.items() for x in (F.lit(name), F.lit(train_docs / n))])
    sample = rows.where(draw < share[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, most=CHUNK_CHARS):
            names = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            found: dict[tuple[str, str], int] = {}
            data, starts, length, at = words(texts)
            raw = data.tobytes()
            for i, name in enumerate(names):
                for s, n in zip(starts[at[i]:at[i + 1]].tolist(), length[at[i]:at[i + 1]].tolist()):
                    key = name, raw[4 * s:4 * (s + n)].decode("utf-32-le", "surrogatepass")
                    found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in found], "word": [k[1] for k in found],
                                              "n": pa.array(found.values(), pa.int64())})
    words_ = sample.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts: dict[str, dict[str, int]] = {}
    for name, word, n in words_.collect():
        counts.setdefault(name, {})[word] = n
    return fit(pieces.load(path), counts)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Scorer:
    """Log-probabilities of texts, remembering words (by 64-bit hashes)."""

    def __init__(self, model: Model):
        self.model, self.matcher = model, Matcher(model.vocabulary)
        self.forget()

    def forget(self) -> None:
        self.known, self.score = np.zeros(0, np.uint64), np.zeros((0, len(self.model.languages)))

    def texts(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each text in each language, and its number of words."""
        data, starts, length, at = words(texts)
        out = np.zeros((len(texts), len(self.model.languages)))
        if not len(starts):
            return out, np.diff(at)
        unit, one, back = np.unique(word_keys(data, starts, length), return_index=True, return_inverse=True)
        if len(self.known) * (8 + self.score.itemsize * len(self.model.languages)) > REMEMBERED:
            self.forget()
        seen = np.searchsorted(self.known, unit)
        new = np.flatnonzero(self.known[np.minimum(seen, len(self.known) - 1)] != unit if len(self.known)
                             else np.ones(len(unit), bool))
        if len(new):
            raw = data.tobytes()
            units = [raw[4 * s:4 * (s + n)].decode("utf-32-le", "surrogatepass")
                     for s, n in zip(starts[one[new]].tolist(), length[one[new]].tolist())]
            lattice = Lattice(self.matcher, units)
            value = lattice.forward(self.model.log_p)[lattice.ends]
            self.known = np.insert(self.known, seen[new], unit[new])
            self.score = np.insert(self.score, seen[new], value, axis=0)
            seen = np.searchsorted(self.known, unit)
        full = np.flatnonzero(np.diff(at))
        out[full] = np.add.reduceat(self.score[seen][back], at[:-1][full])
        return out, np.diff(at)


def identify(spark: SparkSession, docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fh, row, lang_pred, score, n_words: one row per row of ``docs``."""
    src = positioned(docs, doc_id=col(doc_id), text=col(text))
    kind = src.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)  # bounded by vocabulary and languages
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in WORKER:
            WORKER.clear()
            WORKER[key] = Scorer(shared.value) if shared.value.languages else None
        scorer = WORKER[key]
        names = np.array([*shared.value.languages, UNDETERMINED], object)
        try:
            yield from predictions(batches, scorer, names)
        finally:  # later stages share this process: words go when the task ends
            if scorer:
                scorer.forget()

    def predictions(batches: Iterator[pa.RecordBatch], scorer: Scorer | None, names: np.ndarray) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, most=CHUNK_CHARS):
            best, score, n = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            if scorer:
                value, n = scorer.texts(texts)
                some = np.flatnonzero(n)
                best[some] = value[some].argmax(axis=1)
                score[some] = 1 / np.exp(value[some] - value[some].max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "fh", "row")]
                + [pa.array(names[best], pa.string()), pa.array(score), pa.array(n, pa.int64())],
                ["doc_id", "fh", "row", "lang_pred", "score", "n_words"])
    return src.mapInArrow(run, f"doc_id {kind}, fh long, row long, lang_pred string, score double, n_words long")


def keep_identified(spark: SparkSession, docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is determined with at least ``least`` posterior
    probability, with all their columns."""
    docs = anchored(docs)
    found = identify(spark, docs, train(spark, docs))
    gone = stage(found.where((F.col("lang_pred") == UNDETERMINED) | (F.col("score") < least)).select("fh", "row"), "und")
    return keep_positions(docs, gone, "left_anti")
