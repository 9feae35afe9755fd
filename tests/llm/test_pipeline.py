"""The corpus pipeline against a plain version of each stage, on a small corpus with nulls, empty texts, repeated
rows, equal and near copies, benchmark passages and clashing columns."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordlake.llm import op1_langid as langid
from recordlake.llm import pieces

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def exact(rows):
    keep = {}
    for r in rows:
        k = r["text"] or ""
        if k not in keep or r["doc_id"] >= keep[k]["doc_id"]:
            keep[k] = r
    return list(keep.values())


def near(rows):
    sets, parent = [shingles(r["text"]) for r in rows], list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                parent[top(i)] = top(j)
    best = {}
    for i, r in enumerate(rows):
        best[top(i)] = min(best.get(top(i), r), r, key=lambda x: x["doc_id"])
    return list(best.values())


def clean(rows, items):
    def holds(text, item):
        w, x = words(text), words(item)
        if len(x) >= 5:
            return len(shingles(item) & shingles(text)) >= 0.8 * len(shingles(item))
        return bool(x) and any(w[i:i + len(x)] == x for i in range(len(w) - len(x) + 1))
    return [r for r in rows if not any(holds(r["text"], i) for i in items)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows, r = [x.asDict() for x in docs.collect()], random.Random(3)
    texts = [x["text"] for x in rows if len(words(x["text"])) > 60]

    def add(text, **more):
        rows.append({"doc_id": 10_000 + len(rows), "text": text, "lang": "en", "source": "extra", "n_chars": len(text or ""), **more})
    add(None)
    add("")
    add("12 34 !!")
    for t in r.sample(texts, 6):
        add(t)                                       # equal
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        add(" ".join(w))                             # near
    add(texts[0], lang=None, source=None, n_chars=None)
    add("Some words around " + items.first()["text"] + " and after it")
    add("x " * 3000)
    rows.append(dict(rows[-3]))                      # one row twice
    spark.createDataFrame(rows, docs.schema).withColumn("node", F.lit("n")).withColumn("fh", F.lit(1)).repartition(3).write.parquet(
        f"{root}/documents.parquet")
    items.write.parquet(f"{root}/benchmark.parquet")
    return root, rows, [i["text"] for i in items.collect()]


def test_pipeline_matches_plain_stages(spark, corpus):
    import sentencepiece
    root, rows, items = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    got = corpus_pipeline.run(spark, root)
    assert got.columns[:5] == ["doc_id", "lang", "source", "node", "fh"]
    # language: what has no letters goes, and what isn't told with half the probability
    known = {r.doc_id: r for r in langid.identify(spark, docs, langid.train(spark, docs)).collect()}
    kept = [r for r in rows if known[r["doc_id"]].lang_pred != "und" and known[r["doc_id"]].score >= 0.5]
    assert all(re.search(r"[^\W\d_]", r["text"] or "") for r in kept)
    assert sum(bool(re.search(r"[^\W\d_]", r["text"] or "")) for r in rows) - len(kept) <= 0.02 * len(rows)
    want = clean(near(exact(kept)), items)
    assert 100 < len(want) < len(kept) - 8
    result = {r.doc_id: r for r in got.collect()}
    assert sorted(result) == sorted(r["doc_id"] for r in want)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    for r in want:
        x = result[r["doc_id"]]
        assert (x.lang, x.source, x.node, x.fh) == (r["lang"], r["source"], "n", 1)
        assert x.ids == model.encode(r["text"]) and x.n_tokens == len(x.ids)
        assert x.round_trip == (model.decode(x.ids) == r["text"])


def test_stages_keep_columns_and_take_empty_tables(spark, corpus):
    root, rows, _ = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, root)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, root).count() == 0
