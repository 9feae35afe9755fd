"""Operator 9, language-model scoring by masked pseudo-likelihood.

A small network predicts every word of a text from the two words on either side of it:
embeddings of the four neighbours, scaled for each place, are summed and squashed, and a
softmax gives the word's class; the word's share of its class comes from counts. The
summed conditional log-probabilities score the text.

Words are hashed to ``BUCKETS`` values, counted over all documents. The most frequent have
a class of their own, the others fall by frequency into classes of equal mass. The network
is trained in numpy: each task makes one pass of Adagrad over its own documents, with every
word a target, and Spark averages the tasks' parameters, weighted by their targets. So every
word of every document trains the model, and what is gathered grows with the input;
the model itself has a fixed size.

Defined cases: null, empty and wordless texts have no tokens, a sum of 0 and a null mean;
places beyond a text's ends have an embedding of their own that stays zero; repeated rows
train again and get equal scores; an empty table gives no rows; other columns are ignored.
Figures depend on how rows are dealt to tasks, within the noise of averaging.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import chunks, col, ship
from recordlake.llm.shingles import mix, word_hashes

BUCKETS, INPUTS, SIZE = 1 << 16, 1 << 12, 16
OWN, SHARED = 96, 32
CLASSES = OWN + SHARED
PLACES = (-2, -1, 1, 2)
BATCH, RATE = 2048, 0.1


def buckets(texts) -> tuple[np.ndarray, np.ndarray]:
    h, at = word_hashes(texts)
    return (h >> np.uint64(48)).astype(np.int64), at


@dataclass
class Classes:
    """Class of each bucket, and the log of its share of the class."""
    of: np.ndarray
    log_share: np.ndarray

    @staticmethod
    def from_counts(count: np.ndarray) -> "Classes":
        order = np.argsort(-count, kind="stable")
        of = np.empty(BUCKETS, np.int64)
        of[order[:OWN]] = np.arange(OWN)
        rest = order[OWN:]
        mass = np.cumsum(count[rest] + 0.5)
        of[rest] = OWN + np.minimum((mass / mass[-1] * SHARED).astype(np.int64), SHARED - 1)
        n = count + 0.5
        return Classes(of, np.log(n / np.bincount(of, n, CLASSES)[of]))


class Network:
    """Parameters as one flat vector: embeddings, place scales, output weights, biases."""
    PARTS = ((INPUTS + 1, SIZE), (len(PLACES), SIZE), (SIZE, CLASSES), (CLASSES,))
    LENGTH = sum(int(np.prod(p)) for p in PARTS)

    def __init__(self, flat: np.ndarray | None = None):
        if flat is None:
            flat = np.random.default_rng(7).normal(0, 0.1, self.LENGTH).astype(np.float32)
        self.flat = flat.astype(np.float32)
        parts, at = [], 0
        for shape in self.PARTS:
            n = int(np.prod(shape))
            parts.append(self.flat[at:at + n].reshape(shape))
            at += n
        self.embed, self.scale, self.out, self.bias = parts
        self.embed[INPUTS] = 0

    @classmethod
    def start(cls) -> "Network":
        net = cls()
        net.scale[:] = 1
        net.bias[:] = 0
        return net

    def hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = self.embed[context]                                   # (n, places, size)
        return parts, np.tanh(np.einsum("nps,ps->ns", parts, self.scale))

    def log_class(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        z = self.hidden(context)[1] @ self.out
        z += self.bias
        z -= z.max(axis=1, keepdims=True)
        own = z[np.arange(len(z)), target]
        return own - np.log(np.exp(z, out=z).sum(axis=1))

    def gradient(self, context: np.ndarray, target: np.ndarray) -> "Network":
        parts, h = self.hidden(context)
        p = h @ self.out
        p += self.bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(p)), target] -= 1
        p /= len(p)
        g = Network(np.zeros(self.LENGTH, np.float32))
        g.out[:], g.bias[:] = h.T @ p, p.sum(axis=0)
        dh = (p @ self.out.T) * (1 - h * h)
        g.scale[:] = np.einsum("nps,ns->ps", parts, dh)
        each = (dh[:, None, :] * self.scale).reshape(-1, SIZE)
        where = context.ravel().astype(np.uint16)  # INPUTS fits; 16 bits are sorted by radix
        order = np.argsort(where, kind="stable")
        where = where[order]
        first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        g.embed[where[first]] = np.add.reduceat(each[order], first, axis=0)
        g.embed[INPUTS] = 0
        return g


def contexts(words: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Input values of the neighbours of the words at ``at``; ``INPUTS`` beyond a text's ends."""
    text = np.searchsorted(offsets, at, side="right") - 1
    lo, hi = offsets[text], offsets[text + 1]
    out = np.empty((len(at), len(PLACES)), np.int64)
    for k, d in enumerate(PLACES):
        p = at + d
        inside = (p >= lo) & (p < hi)
        out[:, k] = np.where(inside, words[np.where(inside, p, 0)] >> 4, INPUTS)
    return out


def count_words(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Occurrences of every bucket over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, texts in chunks(batches):
            total += np.bincount(buckets(texts)[0], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])
    rows = docs.select(col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def train(spark: SparkSession, docs: DataFrame, classes: Classes, text: str = "text") -> Network:
    """The average of the networks that the tasks trained."""
    shared = spark.sparkContext.broadcast(classes)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, square, seen = Network.start(), np.full(Network.LENGTH, 1e-6, np.float32), 0
        first = net.flat.copy()
        for _, texts in chunks(batches):
            words, at = buckets(texts)
            target = np.argsort(mix(np.arange(len(words), dtype=np.uint64)))
            for i in range(0, len(target), BATCH):
                some = target[i:i + BATCH]
                g = net.gradient(contexts(words, at, some), classes_of(shared)[words[some]]).flat
                square += g * g
                net.flat -= RATE * g / np.sqrt(square)
            seen += len(target)
        if seen:
            moved = np.flatnonzero(net.flat != first)  # parameters that the task didn't touch have its start's value
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(moved, -1)), pa.array(np.append((net.flat - first)[moved].astype(np.float64) * seen, seen))],
                ["i", "v"])

    def classes_of(b) -> np.ndarray:
        return b.value.of
    rows = docs.select(col(text).alias("text")).mapInArrow(run, "i long, v double")
    total = {r["i"]: r["v"] for r in rows.groupBy("i").agg(F.sum("v").alias("v")).collect()}
    net = Network.start()
    seen = total.pop(-1, 0)
    if seen:
        net.flat[list(total)] += (np.array(list(total.values())) / seen).astype(np.float32)
    return net


def score(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, pll (summed log-probability), pll_mean: one row per row of ``docs``."""
    ship(spark)
    classes = Classes.from_counts(count_words(docs, text))
    net = train(spark, docs, classes, text)
    shared = spark.sparkContext.broadcast((classes, net.flat))
    src = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, flat = shared.value
        net = Network(flat)
        for batch, texts in chunks(batches):
            words, at = buckets(texts)
            value = classes.log_share[words]
            for i in range(0, len(words), 16_384):
                some = np.arange(i, min(i + 16_384, len(words)))
                value[some] += net.log_class(contexts(words, at, some), classes.of[words[some]])
            n = np.diff(at)
            total = np.zeros(len(n))
            full = np.flatnonzero(n)
            if len(full):
                total[full] = np.add.reduceat(value, at[:-1][full])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(n, pa.int64()), pa.array(total),
                 pa.array(total / np.maximum(n, 1), mask=n == 0)], ["doc_id", "n_tokens", "pll", "pll_mean"])
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens long, pll double, pll_mean double")
