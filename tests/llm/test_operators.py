"""Small cases of every operator against brute force: nulls, empty and long texts, ties, repeated
rows, empty tables, clashing column names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import op1_langid as langid
from recordlake.llm import op3_segment_join as lines
from recordlake.llm import op4_containment as containment
from recordlake.llm import op5_sentencepiece as sp
from recordlake.llm import op6_pii as pii
from recordlake.llm import op7_hash_tree as hash_tree
from recordlake.llm import op8_licences as licence
from recordlake.llm import op9_masked_lm as lm
from recordlake.llm import op10_stream_dedup as stream
from recordlake.llm import licences, pieces

ROWS = [(1, "Same text.", "en"), (2, "Same text.", "de"), (2, "Same text.", "de"), (3, None, None), (4, "", "en"),
        (5, "x " * 30_000, "fr"), (None, "Mail a@b.co or +1 (415) 555-0100.", "en")]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, fh long, row string, node string, found string"
    return spark.createDataFrame([(*r, 1, "r", "n", "f") for r in ROWS], schema)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def test_exact_dedup(spark, docs, empty):
    got = stream.stream_dedup(spark, docs).collect()
    assert len(got) == len(ROWS)
    same = [r for r in got if r.doc_id in (1, 2)]
    assert {r.keep_id for r in same} == {2} and {r.group_size for r in same} == {3}
    assert sum(r.kept for r in same) == 1
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got if r.doc_id in (3, 4)) == [(3, 4, False), (4, 4, True)]
    kept = stream.drop_copies(spark, docs)
    assert kept.columns == docs.columns and kept.count() == 4
    assert stream.stream_dedup(spark, empty).count() == 0


def test_exact_dedup_checks_bytes_under_a_weak_digest(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "aa"), (4, "c")], "doc_id long, text string")
    got = stream.stream_dedup(spark, df, digest=lambda t: F.length(t).cast("string").cast("binary")).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [
        (1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 4, 1, True)]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_over_calls(spark, tmp_path, monkeypatch, weak):
    monkeypatch.setattr(stream, "RUNS", 2)
    digest = (lambda t: F.length(t).cast("string").cast("binary")) if weak else stream.sha256
    state = f"file://{tmp_path}/state"

    def call(*rows):
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        got = stream.stream_dedup(spark, df, digest=digest, state_dir=state).collect()
        return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got)
    assert call((1, "aa"), (2, "bb"), (3, "aa")) == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True)]
    # equal to and, under the weak digest, colliding with rows of the first call
    assert call((4, "bb"), (5, "cc"), (6, "x")) == [(4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True)]
    assert call((0, "aa"), (7, None)) == [(0, 3, 3, False), (7, 7, 1, True)]
    assert call((8, "cc"), (9, "cc"), (10, "")) == [(8, 9, 3, False), (9, 9, 3, True), (10, 10, 2, True)]
    assert len(stream.State(spark, state, "bigint").runs()) <= 3


def test_exact_dedup_epoch_runs_again(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string").withColumn("digest", stream.sha256(F.col("text")))
    df = df.withColumns({"fh": F.lit(1).cast("long"), "row": F.col("doc_id"), "path": F.lit(None).cast("string")})
    state = stream.State(spark, f"file://{tmp_path}/s", "bigint")
    for _ in range(2):
        stream._fold(state, df, None, df.select("digest", "doc_id", "fh", "row", "path"), 0)
        assert sorted((r.n, r.keeper.doc_id) for r in state.rows().collect()) == [(1, 3), (2, 2)]


def test_hash_tree(spark, docs, empty):
    root = hash_tree.tree(16)
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("é"), F.col("id")).alias("text"))
    rows = hash_tree.shard_rows(df, root, hash_tree.grow(root, 16)).collect()
    for s in range(16):
        mine = [r.slot for r in rows if r.shard == s]
        assert sorted(mine) == list(range(len(mine))) and 170 < len(mine) < 330
    moved = {r.grown_shard for r in rows if r.grown_shard != r.shard}
    assert moved == {16}
    assert all(r.size == len(f"é{r.doc_id}".encode()) + 1 and r.text_crc32 == zlib.crc32(f"é{r.doc_id}".encode()) for r in rows)
    some = hash_tree.shard_rows(docs, root).collect()
    assert len(some) == len(ROWS) and {r.size for r in some if r.doc_id == 3} == {1}
    assert hash_tree.shard_rows(empty, root).count() == 0


def test_a_changed_weight_moves_rows_only_in_and_out_of_its_subtree(spark):
    root = hash_tree.tree(16)
    old = root.children[0].children[0]
    heavier = hash_tree.Node(old.weight + 1, None, (hash_tree.Node(2.0, 0), *old.children[1:]))
    region = hash_tree.Node(9.0, None, (heavier, root.children[0].children[1]))
    new = hash_tree.Node(17.0, None, (region, root.children[1]))
    df = spark.range(3000).select(hash_tree.shard_of(F.col("id"), root).alias("a"), hash_tree.shard_of(F.col("id"), new).alias("b"))
    moved = df.where("a != b").collect()
    assert moved and not [r for r in moved if r.a >= 8 and r.b >= 8]


def test_sentencepiece_equals_the_library(spark, docs):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    r = random.Random(1)
    texts = ["", " ", "a\nb  c\t 12 é日", "\U0001f600 x", "▁a", *[" " * k + "x" for k in range(1, 40)]]
    texts += ["".join(r.choice("abthe  ing.é\n日9▁") for _ in range(r.randint(1, 60))) for _ in range(500)]
    encoder = sp.Encoder(pieces.load())
    ids, at = encoder.encode(texts)
    assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == model.encode(texts)
    out = sp.encode(spark, docs, check=True)
    rows = out.collect()
    assert out.columns[:len(docs.columns)] == docs.columns
    assert all(x.round_trip and x.ids == model.encode(x.text) for x in rows if x.text is not None)
    assert [x.ids for x in rows if x.text is None] == [None]
    assert all(x.back == x.text for x in sp.decode(spark, out, out="back").collect())


def test_language(spark, empty):
    r = random.Random(2)
    words = {"en": ["the", "and", "house", "water", "thing"], "de": ["der", "und", "haus", "wasser", "ding"]}
    rows = [(i, " ".join(r.choice(words[x]) for _ in range(20)), x) for i in range(90) for x in [("en", "de")[i % 2]]]
    rows += [(900, None, "en"), (901, "123 ...", "en"), (902, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in langid.identify(spark, df, langid.train(spark, df)).collect()}
    held = [x for x in rows[:90] if zlib.crc32(str(x[0]).encode()) % 3 == 1]
    assert held and all(got[i].lang_pred == x for i, _, x in held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert langid.identify(spark, empty, langid.train(spark, empty)).count() == 0
    assert sorted(x.doc_id for x in langid.keep_identified(spark, df).collect()) == list(range(90))


def test_forward_sums_all_segmentations():
    v = pieces.load()
    model = langid.fit(v, {"x": {"there": 3, "then": 2}})
    lattice = langid.Lattice(pieces.Matcher(v), ["then"])
    p = dict(zip(v.text, model.log_p[:, 0]))

    def total(t):
        return 1.0 if not t else sum(np.exp(p[t[:k]]) * total(t[k:]) for k in range(1, len(t) + 1) if t[:k] in p)
    assert np.isclose(np.exp(lattice.forward(model.log_p)[lattice.ends][0, 0]), total("▁then"))


def test_leaks(spark, docs, empty):
    item = " ".join(f"q{i}" for i in range(20))
    long = " ".join(f"z{i}" for i in range(3000))
    text = long + " " + item.upper().replace(" ", ", ") + " " + long
    cut = long + " " + " ".join(f"q{i}" for i in range(16)) + " end"
    df = spark.createDataFrame([(1, text), (2, long), (3, cut), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, "too short"), (9, None)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_shared) for r in containment.leaks(spark, df, items).collect())
    assert got == [(1, 7, 16)]  # document 3 has 12 of 16 shingles
    assert containment.leaks(spark, empty, items).count() == 0
    assert containment.leaks(spark, docs, items.limit(0)).count() == 0


def test_short_items_are_found_in_every_document(spark):
    r = random.Random(3)
    texts = [" ".join(f"v{r.randrange(900)}" for _ in range(260)) for _ in range(80)]
    words = [t.split() for t in texts]
    # 1 to 7 words, and 16 words of which two at the end are changed: 10 of 12 shingles
    rows = [(100 * k + i, " ".join(words[i][9 * k:9 * k + k])) for k in range(1, 8) for i in range(80)]
    rows += [(900 + i, " ".join([*words[i][100:114], "end", "here"])) for i in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(rows, "item_id long, text string")

    def parts(w, k):
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    want = set()
    for item, t in rows:
        k = min(5, len(t.split()))
        mine = parts(t.split(), k)
        want |= {(d, item, len(mine), len(mine & parts(w, k))) for d, w in enumerate(words) if len(mine & parts(w, k)) >= 0.8 * len(mine)}
    got = containment.leaks(spark, df, items).collect()
    assert len(got) == len(want) and {(x.doc_id, x.item_id, x.n_item, x.n_shared) for x in got} == want
    long = {x.item_id for x in containment.leaks(spark, df, items, shortest=5).collect()}
    assert long == {i for i, t in rows if len(t.split()) >= 5}


def test_personal_data(spark, docs, empty):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else True,
                "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
    r = random.Random(4)
    texts = ["é a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4", "4111 1111-1111 1111 4111111111111112",
             "+1 (415) 555-0100 +1 ((( +12", "7" * 9000, "a" * 9000 + "@b.c", "@" * 3000, None, "",
             *["".join(r.choice("a1.@+- 5é") for _ in range(40)) for _ in range(400)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.personal_data(df).collect():
        want = [f"{k}:{m.start()}:{m.end()}" for k, p in plain.items()
                for m in re.finditer(p, texts[row.doc_id] or "") if valid(k, m[0])]
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[row.doc_id]
    assert pii.personal_data(empty).count() == 0
    assert {x.n_email for x in pii.personal_data(docs).where("doc_id is null").collect()} == {1}


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"customer reach me at user{i}@mail.example.com today") for i in range(40)]
    rows += [(100, "customer reach me at ZX-99-4471-K today"), (101, "version 20240101 of the thing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert got[100].n_id == 1 and got[100].spans == "id:21:33"
    assert got[101].n_id == 0


def test_licences(spark, docs, empty):
    mit = licences.TEXTS["MIT"]
    rows = [(1, "Copyright (c) 2001 X\n\n" + mit.lower().replace(",", " ;")), (2, "code\nReleased under the MIT licence!\nmore"),
            (3, "released under the mit"), (4, None), (5, mit + "\n\n" + mit)]
    got = {r.doc_id: r for r in licence.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].whole_licence, got[1].licences, got[1].n_found) == ("MIT", "MIT", 1)
    assert (got[2].whole_licence, got[2].licences, got[2].n_found) == (None, "MIT", 1)
    assert got[3].n_found == got[4].n_found == 0
    assert (got[5].whole_licence, got[5].n_found) == (None, 2)
    assert licence.scan(empty).count() == 0 and licence.scan(docs).count() == len(ROWS)


def test_masked_lm(spark, docs, empty):
    rows = [(i, "alpha beta gamma delta " * 60) for i in range(30)] + [(99, "delta delta alpha gamma " * 60), (98, None)]
    got = {r.doc_id: r for r in lm.score(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].pll_mean > got[99].pll_mean and (got[98].n_tokens, got[98].pll, got[98].pll_mean) == (0, 0, None)
    c = lm.Classes.from_counts(np.arange(lm.BUCKETS, dtype=float))
    assert np.allclose(np.bincount(c.of, np.exp(c.log_share)), 1)
    assert lm.score(spark, empty).count() == 0 and lm.score(spark, docs).count() == len(ROWS)


def test_every_word_trains_the_model(spark):
    texts = [f"left{i} mid{i} right{i}" for i in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    net = lm.train(spark, df, lm.Classes.from_counts(lm.count_words(df)))
    inputs = np.unique(lm.buckets(texts)[0] >> 4)
    assert (net.embed[inputs] != lm.Network.start().embed[inputs]).any(axis=1).all()


def test_lines(spark, docs, empty):
    a = "This is a line of some length, number one."
    rows = [(1, a + "\n\nshort\nother"), (2, a.replace("some", "sme") + "\nshort\nshorx"), (3, a.replace("line", "lymph")), (4, None), (5, "")]
    got = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].clean == rows[0][1]
    assert got[2].clean == "shorx" and (got[2].n_copies, got[2].n_near, got[2].n_links) == (1, 1, 1)
    assert got[3].clean == rows[2][1] and got[4].clean is None and got[5].n_lines == 0
    assert lines.dedup_lines(empty).count() == 0 and lines.dedup_lines(docs).count() == len(ROWS)


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("d", [1, 2, 3])
def test_edit_join_misses_no_pair(d):
    r = random.Random(d)
    base = ["".join(r.choice("abé") for _ in range(r.randint(d + 1, 12))) for _ in range(80)]
    pairs = [(x, y) for x in base for y in base]
    true = np.array([_distance(x, y) <= d for x, y in pairs])
    assert (lines.within(pairs, d) == true).all()
    index, probe = lines.keys(base, d, True), lines.keys(base, d, False)
    found = {}
    for line, key in zip(*index):
        found.setdefault(key, set()).add(line)
    met = {(min(i, j), max(i, j)) for j, key in zip(*probe) for i in found.get(key, ())}
    p = lines.parities(base)
    for k, (i, j) in enumerate((i, j) for i in range(80) for j in range(80)):
        if true[k] and i < j:
            assert (i, j) in met and bin(int(p[i] ^ p[j])).count("1") <= 4 * d


@pytest.mark.parametrize("together", [lines.TOGETHER, 2])
def test_near_lines_of_a_large_group_are_all_found(spark, together):
    """Also those whose keys have more rows than a task compares; blank and short lines are left out."""
    r = random.Random(7)
    base = [f"The same long line, number {i:03d} of a group." for i in range(0, 120, 7)]
    base += [x.replace("long", "lo\u00e9g") for x in base[:4]] + [x + "!" for x in base[:3]] + ["zz" * 15, " \t" * 12, "The same"]
    docs = spark.createDataFrame([(i, "\n".join(r.sample(base, 9) + [x])) for i, x in enumerate(base)], "doc_id long, text string")
    real = {hashlib.md5(x.encode()).digest(): x for x in base if len(x) >= lines.SHORTEST and x.strip()}
    got = [tuple(sorted((real[bytes(p.a)], real[bytes(p.b)]))) for p in lines.near_pairs(docs, together=together).collect()]
    want = {(x, y) for x in real.values() for y in real.values() if x < y and _distance(x, y) <= lines.DISTANCE}
    assert len(got) == len(want) > 50 and set(got) == want


def test_pairs_of_a_key_are_made_once():
    """Equal rows of several blocks, and lines that meet under several keys, make no pair again."""
    n = 50
    line = np.tile(np.arange(n, dtype=np.int64), 6)
    key = np.repeat(np.arange(3, dtype=np.uint64), 2 * n)
    x, y, rest = lines.alike(key, line, np.zeros(len(line), np.uint64), np.ones(len(line), bool), 8, 2 * n)
    assert len(x) == n * (n - 1) // 2 and (x < y).all() and not len(rest)
    x, y, rest = lines.alike(key, line, np.zeros(len(line), np.uint64), line < 1, 8, 2 * n)
    assert sorted(y.tolist()) == list(range(1, n)) and not x.any()
    x, y, rest = lines.alike(key, line, np.zeros(len(line), np.uint64), line < 1, 8, n - 1)
    assert not len(x) and len(rest) == 3 * n


def test_texts_of_a_batch_are_converted_in_parts():
    """A task holds the texts of a chunk as Python strings, not those of its batch."""
    import tracemalloc

    import pyarrow as pa

    from recordlake.llm.common import chunks
    texts = [f"{i:06d}" * 2_000 if i % 5 else None for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], ["id", "text"])
    tracemalloc.start()
    got = [(b.column(0).to_pylist(), max(map(len, filter(None, t)), default=0), sum(len(x or "") for x in t))
           for b, t in chunks([batch], most=50_000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [i for ids, _, _ in got for i in ids] == list(range(400)) and all(n <= 50_000 for _, _, n in got)
    assert peak < 1_000_000
    assert [t for _, part in chunks([batch], most=50_000) for t in part] == texts


def test_neighbours_cost_what_their_words_cost(spark):
    """A batch's neighbours are looked up without a pass over all words of the chunk."""
    import tracemalloc
    words, at = np.arange(1_000_000, dtype=np.int64) % lm.BUCKETS, np.array([0, 5, 1_000_000])
    tracemalloc.start()
    got = lm.contexts(words, at, np.array([0, 4, 5, 500_000]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    none = lm.INPUTS
    assert got.tolist() == [[none, none, 0, 0], [0, 0, none, none], [none, none, 0, 0],
                            [int(words[500_000 + d]) >> 4 for d in lm.PLACES]]
    assert peak < 1_000_000


def test_chunks_and_their_caller_hold_one_batch():
    from recordlake.llm.common import chunks
    import pyarrow as pa
    held = []

    def batches():
        for _ in range(4):
            held.append(pa.total_allocated_bytes())
            yield pa.RecordBatch.from_arrays([pa.array(["x" * 1000] * 5000)], ["text"])
    for batch, texts in chunks(batches(), most=10_000_000):
        assert len(texts) == batch.num_rows == 5000
        del batch, texts
    assert max(held) < held[0] + 5_000_000


def test_texts_that_are_not_returned_are_sent_to_python_once(spark, docs):
    out = sp.encode(spark, docs, check=True, without=["text"])
    assert out.columns == [c for c in docs.columns if c != "text"] + ["n_tokens", "ids", "ids_crc32", "round_trip"]
    plan = out._jdf.queryExecution().analyzed().toString()
    sent = next(x for x in plan.splitlines() if "struct" in x and " AS t#" in x)
    assert sent.split(" AS d#")[0].count("text") == 0
    whole = sp.encode(spark, docs, check=True).drop("text")
    assert sorted(map(str, out.collect())) == sorted(map(str, whole.collect()))
