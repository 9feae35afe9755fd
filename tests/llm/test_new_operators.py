"""Operators 11, 12 and 13 against brute force: nulls, empty and long texts, ties, repeated rows,
empty tables, clashing column names."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from recordlake.llm import op11_align as align
from recordlake.llm import op12_mix as mixing
from recordlake.llm import op13_merkle as merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, size long, t long, i long, slot string"


def make(spark, n=300, seed=3):
    r = random.Random(seed)
    words = "the of naïve Straße café données x1 42 <|endoftext|> </s> 日本 don't  tab\tnew\nline".split(" ")
    rows = []
    for i in range(n):
        text = " ".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 12, 60])))
        rows.append((i, r.choice([text, text + "  ", "\n" + text]), r.choice(["en", "en", "en", "dé", "zz", None]),
                     r.choice(["s1", "s1", "s1", "s2", "é", None, "s10"]), len(text), "c", 1, 2, 3, "s"))
    rows += [(7, "same row", "en", "s1", 8, "c", 1, 2, 3, "s")] * 5
    rows += [(None, None, None, None, None, None, None, None, None, None), (900, "", "en", "s1", None, "c", 1, 2, 3, "s"),
             (901, "word " * 30_000, "fr", "s2", 150_000, "c", 1, 2, 3, "s"), (902, "a\x00b ﬁ Å", "fr", "s3", 5, "c", 1, 2, 3, "s")]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def corpus(spark):
    return make(spark)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# 13

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_merkle(rows):
    def leaf(r, more=0):
        n = None if r[4] is None else r[4] + more
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], n, r[1])])

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][k:k + 2]) for k in range(0, len(levels[-1]), 2)])
        return levels
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, order = {}, {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        order[lang], trees[lang] = mine, climb([leaf(r) for r in mine])
    top = climb([trees[x][-1][0] for x in langs])
    out = []
    for t, lang in enumerate(langs):
        for i, r in enumerate(order[lang]):
            steps = []
            for levels, k in ((trees[lang], i), (top, t)):
                for level in levels[:-1]:
                    steps.append((k % 2, level[k ^ 1] if (k ^ 1) < len(level) else None))
                    k //= 2
            x = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for right, s in steps:
                x = sha(x) if s is None else sha(s, x) if right else sha(x, s)
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], sha(*[s for _, s in steps if s]), x, x == top[-1][0]))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("levels", [10, 2])
def test_merkle(spark, corpus, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows, df = corpus
    got = merkle.tamper_check(spark, df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute_merkle(rows)
    assert ordered(got.collect()) == ordered(want)
    assert 0 < sum(not r[-1] for r in want) < len(want) / 3


def test_merkle_of_one_row_and_none(spark, nothing):
    one = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    r = merkle.tamper_check(spark, one).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == sha("")
    assert merkle.tamper_check(spark, nothing).collect() == []


def test_merkle_proof_of_some_rows_fetches_the_fewest_nodes(spark, corpus):
    rows, df = corpus
    m = merkle.manifest(df)
    some = m.leaves.where("order in (5, 7, 120, 901)")
    every = {tuple(r) for r in merkle.prove(m).collect()}
    got = merkle.prove(m, some).collect()
    assert len(got) == 8 + 1 and all(tuple(r) in every and r.verified for r in got)


def test_missing_is_minimal():
    r = random.Random(1)
    for size in (1, 2, 3, 7, 8, 21, 64):
        some = r.sample(range(size), r.randint(1, size))
        need = merkle.missing(some, size)
        assert len(set(need)) == len(need)
        nodes = {(0, i): sha(str(i)) for i in range(size)}
        merkle.derive(nodes, range(size), size)
        have = {(0, i): nodes[0, i] for i in some} | {c: nodes[c] for c in need}
        merkle.derive(have, some, size)
        assert have.items() <= nodes.items()
        for i in some:
            assert merkle.fold(nodes[0, i], merkle.path(have, i, size)) == nodes[merkle.depth(size), 0]
        for c in need:  # none can be left out: it can't be derived from the leaves held and the other nodes
            below = {i for i in range(size) if i >> c[0] == c[1]}
            assert not below & set(some)


# 12

def brute_targets(sizes):
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        want = {s: 3 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        over = {s for s in names if want[s] > 3 * sizes[s]}
        if not over:
            return want
        full |= over


def words(text):
    return len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")])


@pytest.mark.parametrize("block", [512, 7])
def test_mix(spark, corpus, block):
    rows, df = corpus
    plain = mixing.taken(spark, df)
    got = plain.collect()
    assert ordered(got) == ordered(mixing.taken(spark, df.repartition(2)).collect())
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r[0], r[3], words(r[1])) for r in rows)
    sizes, took = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r["size"]
        took[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    want = brute_targets(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(took[s] - want[s]) <= 0.5 for s in want)
    # the schedule itself: every slot once, blocks in order, each full but a source's last, sources interleaved
    stream = mixing.mix(df, block=block).collect()
    by_slot = defaultdict(list)
    for r in stream:
        by_slot[r.slot].append(r)
    assert sorted(by_slot) == list(range(len(by_slot)))
    seen, filled, total = Counter(), Counter(), sum(want.values())
    for t in range(len(by_slot)):
        [s] = {r.source for r in by_slot[t]}
        assert {r.block for r in by_slot[t]} == {seen[s]}
        n = sum(r.last - r.first for r in by_slot[t])
        filled[s] += n
        seen[s] += 1
        assert n == block or filled[s] == took[s]
        if block == 7:
            assert all(abs(seen[x] - (t + 1) * want[x] / total) < 6 for x in want)
    each = Counter()
    for r in stream:
        each[r.doc_id, r.source] += r.last - r.first
    plainly = Counter()
    for r in got:
        plainly[r.doc_id, r.source] += r.taken
    assert +each == +plainly


def test_mix_places_many_copies_of_a_row_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_COPIES", 3)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 2)
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", 2)
    df = spark.createDataFrame([(1, "s", "a b c")] * 20 + [(2, "s", "d"), (3, "t", "e f")], "doc_id long, source string, text string")
    got = mixing.taken(spark, df).collect()
    # t stops at 6 words, s takes the other 57 of its 61
    assert len(got) == 22 and sum(r.taken for r in got if r.source == "t") == 6
    assert sum(r.taken for r in got) == 63 and {r.taken for r in got if r.source == "s"} <= {0, 1, 2, 3}
    stream = mixing.mix(df, block=2).collect()
    assert sorted({r.slot for r in stream}) == list(range(29 + 3)) and sum(r.last - r.first for r in stream) == 63


def test_mix_without_words(spark, nothing):
    assert mixing.taken(spark, nothing).collect() == []
    df = spark.createDataFrame([(1, "s", None), (1, "s", None), (2, None, " ")], "doc_id long, source string, text string")
    assert [(r["size"], r.target, r.taken) for r in mixing.taken(spark, df).collect()] == [(0, 0.0, 0)] * 3


def test_golden_step():
    for n in (1, 2, 3, 10, 97, 10 ** 6, 3 * 10 ** 11):
        g = mixing.golden_step(n)
        assert (g * pow(g, -1, n) - 1) % n == 0
        assert n < 10 or abs(g / n - 0.6180339887) < 0.1
    assert abs(mixing.golden_step(10 ** 9) / 10 ** 9 - 0.61803398875) < 1e-7


# 11

def brute_align(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    pa, pb = align.default_paths()
    t = Tokenizer.from_file(pa)
    t.encode_special_tokens = True
    m = sentencepiece.SentencePieceProcessor(model_file=pb)
    letters = align.byte_letters()
    docs = []
    for r in rows:
        text, links, groups, a, b = r[1], [], [], [], []
        if text:
            a = t.encode(" " + text, add_special_tokens=False).ids
            b = m.encode(text)
            ba = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
            bb = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(ba) == b"".join(bb) == (" " + text).encode():
                a, b = [], []
            if a:
                i = j = ea = eb = 0
                ga, gb = [], []
                while i < len(a) or j < len(b):  # by single steps: the side that is behind takes its next token
                    if ea <= eb and not (ea == eb and len(ga) > len(gb)):
                        ga.append(a[i])
                        ea += len(ba[i])
                        i += 1
                    else:
                        gb.append(b[j])
                        eb += len(bb[j])
                        j += 1
                    if ea == eb:
                        groups.append((ga, gb))
                        ga, gb = [], []
                sa = se = 0
                spans_b, x = [], 0
                for q in bb:
                    spans_b.append((x, x + len(q)))
                    x += len(q)
                x = k = 0
                for i, q in zip(a, ba):
                    lo, hi = x, x + len(q)
                    x = hi
                    while spans_b[k][1] <= lo:
                        k += 1
                    z = k
                    while z < len(b) and spans_b[z][0] < hi:
                        links.append((i, b[z]))
                        z += 1
        docs.append((r[0], a, b, groups, links))
    count = Counter(p for d in docs for p in set(d[4]))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for d, a, b, groups, links in docs:
        g = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sha(g) if a else "",
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links)))
    return out


def test_align(spark, corpus, nothing, monkeypatch):
    rows, df = corpus
    got = align.aligned(spark, df)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    want = brute_align(rows)
    assert ordered(got.collect()) == ordered(want)
    assert sum(r[1] > 0 for r in want) > 200
    assert align.aligned(spark, nothing).collect() == []


def test_fast_byte_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    path = align.default_paths()[0]
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    r = random.Random(11)
    texts = ["a" + " " * 200_000 + "b", "\n" * 50_000, "<|endoftext|>", " <|endoftext|> x", "it's 'S 's", "x" * 20_000, "日本語" * 500,
             "\u00a0\u2003 \x85 \x1c", "e\u0301 \U0001f600\u200d"]
    letters = [chr(c) for c in (*range(32, 127), 9, 10, 13, 0xA0, 0xE9, 0x301, 0x4E2D, 0x1F600, 0x660, 0x2028)]
    texts += ["".join(r.choice(letters) for _ in range(60)) for _ in range(500)]
    assert align.byte_ranks(path) is not None
    side = align.byte_bpe(path)
    assert side.encode(texts) == [t.encode(" " + x, add_special_tokens=False).ids for x in texts]


def test_align_with_small_chunks_and_memo(spark, corpus):
    rows, _ = corpus
    w = align.Windows(*[f(p) for f, p in zip((align.byte_bpe, align.piece_bpe), align.default_paths())])

    def run(texts):
        return [g and (g[:4], sorted(g[4].tolist())) for g in align.align_texts(w, texts, w.a.encode(texts), w.b.encode(texts))]
    texts = [r[1] for r in rows if r[1]]
    one = []
    for i, t in enumerate(texts):
        one += run([t])
        if i % 3 == 0:
            w.clear()
    assert one == run(texts) == run(texts)  # alone, together with new windows, and all from the memo


def test_pairs_of_chunks_that_batches_cut(spark, corpus):
    _, df = corpus
    rows = align.encoded(df)
    some, total = align.pair_counts(rows)
    got = {r.code: (r.n, r.best) for r in total.collect()}
    want = Counter(c for r in rows.collect() for c in r.pairs)
    assert {c: n for c, (n, _) in got.items()} == want
    best = defaultdict(int)
    for c, n in want.items():
        best[c >> 32] = max(best[c >> 32], n)
    assert all(b == (n == best[c >> 32]) for c, (n, b) in got.items())
