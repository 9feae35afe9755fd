import random

import numpy as np
import pytest

from recordlake.llm import op2_probminhash as near
from recordlake.llm.shingles import shingle_hashes


def brute(texts):
    """Classes by comparing all pairs of word-shingle sets."""
    import re
    sets = []
    for t in texts:
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(texts))]


def corpus(seed=5):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(25):
        base = [r.choice(words) for _ in range(r.randint(60, 200))]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            out.append(" ".join(copy))
    return out + ["", None, "...", "one two", "One, two!", "one two", " ".join(words * 30)]


@pytest.fixture(scope="module")
def result(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, node string, fh long")
    return texts, {r.doc_id: r for r in near.near_classes(docs).collect()}


def test_classes_match_all_pairs(result):
    texts, got = result
    want = brute(texts)
    assert {i: r.class_id for i, r in got.items()} == dict(enumerate(want))
    assert all(r.kept == (r.class_id == i) for i, r in got.items())
    assert all(r.class_size == want.count(want[i]) for i, r in got.items())


def test_registers_agree_with_the_probability_jaccard():
    a = " ".join(f"a{i}" for i in range(300))
    b = " ".join([f"a{i}" for i in range(240)] + [f"b{i}" for i in range(60)])
    t, e, w = near.weighted(*shingle_hashes([a, b]))
    s = near.signatures(t, e, w, 2, 4096)
    shared, total = 236, 356
    assert abs((s[0] == s[1]).mean() - shared / total) < 0.04
    bits = near.compact(s[:, :252]).view(np.uint64)
    assert bits.shape == (2, 16)


def test_empty_table(spark):
    assert near.near_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_stage_keeps_columns_and_one_row_of_a_class(spark):
    t = " ".join(f"k{i}" for i in range(50))
    docs = spark.createDataFrame([(3, t, "en"), (3, t, "en"), (2, t + " more", "de"), (9, None, None)], "doc_id long, text string, lang string")
    out = near.drop_near_copies(spark, docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 9]


@pytest.mark.parametrize("times", [5, 20])
def test_a_passage_repeated_more_often_is_still_linked(spark, times):
    texts = []
    for k in range(20):
        body = " ".join(f"b{k}x{i}" for i in range(240))
        footer = " ".join(f"f{k}x{i}" for i in range(60))
        texts += [f"{body} {footer}", " ".join([body, *[footer] * times])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near.near_classes(docs).collect()}
    assert got == dict(enumerate(brute(texts))) == {i: i - i % 2 for i in range(40)}


def crowd(n, seed=7):
    """A text's close copies, and as many with changes that several have, too many for a link."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    out = []
    for k in range(n):
        copy = list(base)
        for p in r.sample(range(5, 145, 5), 1 if k % 2 else 5):
            copy[p] = f"x{p}y{r.randrange(n // 20)}"
        out.append(" ".join(copy))
    return out


def test_outliers_of_a_crowd_are_not_compared_with_all_of_it(spark, monkeypatch):
    staged, made = near.stage, []

    def counted(df, name):
        out = staged(df, name)
        if name == "met" and out.columns == ["a", "b"]:
            made.append(out.count())
        return out
    monkeypatch.setattr(near, "stage", counted)
    monkeypatch.setattr(near, "CROWD", 8, raising=False)
    texts = crowd(240)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near.near_classes(docs).collect()}
    assert got == dict(enumerate(brute(texts)))
    assert 100 < len(set(got.values())) < 240
    assert sum(made[near.FIRST_ROUNDS:]) < 240 * 240 / 16  # 15,226 when all open members were compared with outliers


def test_rare_shingles_find_links_in_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(near, "CROWD", 8, raising=False)
    texts = crowd(240)
    base = texts[0].split()
    hidden = [" ".join(base[:-1]), " ".join(base[1:])]  # links of one outlier, alike in their rare shingles only
    got = {r.doc_id: r.class_id for r in near.near_classes(spark.createDataFrame(
        list(enumerate(texts + hidden)), "doc_id long, text string")).collect()}
    assert got == dict(enumerate(brute(texts + hidden)))
    assert got[240] == got[241] == got[0]


def test_crowded_finds_all_pairs_that_share_a_rare_shingle(spark):
    r = random.Random(3)
    sets = [[k, *sorted({*r.sample(range(100), 88), *(1000 + r.randrange(60) for _ in range(6))})] for k in range(80)]
    sets += [[80 + k, *sorted({*s[1:-1], 2000 + k})] for k, s in enumerate(sets[:20])]
    rows = [(bytes([s[0]]), s[1:], 100, bytes([s[0]])) for s in sets]
    texts = near.stage(spark.createDataFrame(rows, "node binary, shingles array<long>, crowd long, comp binary"), "t")
    common, pairs = near.crowded(texts, 0.8)
    found = {(p.a[0], p.b[0]) for p in pairs.collect()}
    common = {c.node[0]: c.common for c in common.collect()}
    count = {}
    for s in sets:
        for x in s[1:]:
            count[x] = count.get(x, 0) + 1
    whole = {s[0]: set(s[1:]) for s in sets}
    assert common == {k: sum(count[x] > 10 for x in s) for k, s in whole.items()}
    linked = {(i, j) for i in whole for j in whole if i < j and len(whole[i] & whole[j]) >= 0.8 * len(whole[i] | whole[j])}
    rare = {(i, j) for i, j in linked if any(1 < count[x] <= 10 for x in whole[i] & whole[j])}
    assert rare and rare <= found
    assert all(near.SIMILARITY * (len(whole[i]) + len(whole[j]) - min(common[i], common[j])) <= min(common[i], common[j])
               for i, j in linked - rare)
