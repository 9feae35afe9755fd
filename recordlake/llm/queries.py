"""Registered queries of the text operators, over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.llm import op1_langid as langid
from recordlake.llm import op2_probminhash as near
from recordlake.llm import op3_segment_join as lines
from recordlake.llm import op4_containment as containment
from recordlake.llm import op5_sentencepiece as sentencepiece_
from recordlake.llm import op6_pii as pii
from recordlake.llm import op7_hash_tree as hash_tree
from recordlake.llm import op8_licences as licence
from recordlake.llm import op9_masked_lm as lm
from recordlake.llm import op10_stream_dedup as stream
from recordlake.llm import op11_align as align
from recordlake.llm import op12_mix as mixing
from recordlake.llm import op13_merkle as merkle
from recordlake.llm.common import table


def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(spark, docs, langid.train(spark, docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_words")


def op2(spark, sf_dir):
    return near.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op3(spark, sf_dir):
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return out.withColumn("clean_sha256", F.sha2(F.coalesce("clean", F.lit("")), 256)).drop("fh", "row", "clean")


def op4(spark, sf_dir):
    found = containment.leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("fh", "row")


def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_.encode(spark, docs, ids=False, check=True, without=["text"])


def op6(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("found")


def op7(spark, sf_dir):
    root = hash_tree.tree(16)
    return hash_tree.shard_rows(table(spark, sf_dir, "documents"), root, hash_tree.grow(root, 16))


def op8(spark, sf_dir):
    return licence.scan(table(spark, sf_dir, "documents"))


def op9(spark, sf_dir):
    return lm.score(spark, table(spark, sf_dir, "documents"))


def op10(spark, sf_dir):
    out = stream.stream_dedup(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11(spark, sf_dir):
    return align.aligned(spark, table(spark, sf_dir, "documents"))


def op12(spark, sf_dir):
    return mixing.taken(spark, table(spark, sf_dir, "documents"))


def op13(spark, sf_dir):
    return merkle.tamper_check(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_segmentation_unigrams": op1,
    "op2_probminhash": op2,
    "op3_segment_line_dedup": op3,
    "op4_minhash_containment": op4,
    "op5_suffix_array_sentencepiece": op5,
    "op6_bootstrapped_pii": op6,
    "op7_weighted_hash_tree": op7,
    "op8_licence_digests": op8,
    "op9_masked_lm": op9,
    "op10_streaming_exact_dedup": op10,
    "op11_whitespace_anchors": op11,
    "op12_golden_schedule": op12,
    "op13_octopus_merkle": op13,
}


def _shingles(key: str, source: str) -> str:
    """Distinct five-word shingles in SQL: words are runs of ASCII letters, digits and characters outside ASCII."""
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+')"
    return (f"select distinct {key}, unnest(list_transform(range(1, len(w) - 3), "
            f"lambda i: array_to_string(w[i:i + 4], ' '))) s from (select {key}, {words} w from {source}) where len(w) >= 5")


def _classes() -> str:
    """Texts of equal words are one node; nodes whose shingle sets are similar are linked; classes are what links reach."""
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+')"
    return (f"with recursive d as (select doc_id, array_to_string(w, ' ') node, w from (select doc_id, {words} w from documents)), "
            "n as (select distinct node, w from d where node <> ''), "
            "s as (select distinct node, unnest(case when len(w) < 5 then [node] else "
            "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) s from n), "
            "z as (select node, count(*) size from s group by 1), "
            "p as (select a.node a, b.node b, count(*) c from s a join s b using (s) where a.node <> b.node group by 1, 2), "
            "e as (select a, b from p join z x on x.node = a join z y on y.node = b where c >= 0.8 * (x.size + y.size - c)), "
            "reach as (select node a, node b from n union select r.a, e.b from reach r join e on e.a = r.b), "
            "m as (select a node, min(b) comp from reach group by 1), "
            "c as (select doc_id, coalesce(comp, 'no words ' || doc_id) comp from d left join m using (node)) "
            "select doc_id, min(doc_id) over g class_id, count(*) over g class_size, doc_id = min(doc_id) over g kept "
            "from c window g as (partition by comp)")


def _mix() -> str:
    """Targets by water filling, rows by the digest's order, each source's run of words repeated up to its quota."""
    taken = " + ".join(f"greatest(0, least(pos + {e} * source_size + size, quota) - (pos + {e} * source_size))" for e in range(3))
    return (r"with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) size, "
            "md5(coalesce(doc_id::varchar, '-') || ':' || coalesce(text, '')) mark from documents), "
            "s as (select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) - 1 sid "
            "from d group by source), "
            "w as (select *, [5, 2, 1][sid % 3 + 1] weight, 3 * source_size most from s), "
            "l as (select *, (sum(source_size) over () - (sum(most) over f - most))::double / "
            "sum(weight) over (order by most / weight, sid rows between current row and unbounded following) lev from w "
            "window f as (order by most / weight, sid rows between unbounded preceding and current row)), "
            "t as (select source, source_size, least(most::double, max(lev) over () * weight) target from l), "
            "q as (select *, floor(target + 0.5)::bigint quota from t), "
            "p as (select d.doc_id, d.source, d.size, q.source_size, q.target, q.quota, "
            "sum(size) over (partition by d.source order by mark, doc_id, size rows between unbounded preceding and current row) "
            "- size pos from d join q on d.source is not distinct from q.source) "
            "select doc_id, size::bigint size, source, source_size, target, "
            f"(case when size = 0 then 0 else {taken} end)::bigint taken from p")


def _merkle() -> str:
    """Levels by a recursive aggregate, proofs from every level's sibling, folds by a reduction over them."""
    def leaf(n_chars: str) -> str:
        cols = ("doc_id", "source", "lang", n_chars, "text")
        return "sha256(" + " || ".join(
            f"coalesce(octet_length(encode(({c})::varchar))::varchar || ':' || ({c})::varchar, '-')" for c in cols) + ")"
    step = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    crc = (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda k: "
           f"ord(k)::bigint)), lambda c, b: {step}), 4294967295)")

    def climb(name: str, leaves: str) -> str:
        return (f"{name} as (select t, 0 lev, i, n, x from {leaves} union all select t, lev + 1, i // 2, (n + 1) // 2, "
                f"sha256(string_agg(x, '' order by i)) from {name} where n > 1 group by t, lev, i // 2, n)")
    return ("with recursive d as (select doc_id, n_chars, lang, " + leaf("n_chars") + " leaf, "
            f"case when {crc} % 7 = 0 and n_chars is not null then " + leaf("n_chars + 1") + " else " + leaf("n_chars")
            + " end start from documents), "
            "l as (select *, leaf x, dense_rank() over (order by lang nulls first) - 1 t, count(*) over (partition by lang) n, "
            "row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 i, row_number() over () rid from d), "
            + climb("up", "l") + ", "
            "sub as (select 0 t, t i, count(*) over () n, x from up where n = 1), " + climb("top", "sub") + ", "
            "nodes as (select 0 part, * from up union all select 1, * from top), "
            "spot as (select rid, 0 part, t, i, n from l union all select rid, 1, 0, t, (select count(*) from sub) from l), "
            "lev as (select *, unnest(range(ceil(log2(n))::bigint)) lev from spot), "
            "steps as (select rid, v.part, v.lev, case when s.x is null then '-' when (v.i >> v.lev) % 2 = 1 then 'L' || s.x "
            "else 'R' || s.x end step from lev v left join nodes s on s.part = v.part and s.t = v.t and s.lev = v.lev "
            "and s.i = xor(v.i >> v.lev, 1)), "
            "proofs as (select rid, list(step order by part, lev) steps from steps group by rid), "
            "f as (select l.*, coalesce(steps, []) steps, list_reduce(list_prepend(start, coalesce(steps, [])), "
            "lambda a, s: case when s = '-' then sha256(a) when s[1] = 'L' then sha256(s[2:] || a) else sha256(a || s[2:]) end) "
            "folded_root from l left join proofs using (rid)) "
            "select doc_id, leaf, sub.x subroot, top.x root, sha256(array_to_string(list_transform(list_filter(steps, "
            "lambda s: s <> '-'), lambda s: s[2:]), '')) proof_sha256, folded_root, folded_root = top.x verified "
            "from f join sub on sub.i = f.t join top on top.n = 1")


def _words(key: str, source: str, name: str) -> str:
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+')"
    return f"{name} as (select {key}, array_to_string(w, ' ') w, len(w) n from (select {key}, {words} w from {source}))"


ORACLE = {
    "op2_probminhash": _classes(),
    "op4_minhash_containment":
        "with i as (" + _shingles("item_id", "benchmark") + "), "
        "d as (" + _shingles("doc_id", "documents") + "), "
        "n as (select item_id, count(*) n_item from i group by 1), "
        "p as (select doc_id, item_id, count(*) n_shared from i join d using (s) group by 1, 2), "
        + _words("item_id", "benchmark", "iw") + ", " + _words("doc_id", "documents", "dw") +
        " select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment from p join n using (item_id) "
        "where n_shared / n_item >= 0.8 union all "
        "select doc_id, item_id, 1, 1, 1.0 from iw join dw on contains(' ' || dw.w || ' ', ' ' || iw.w || ' ') where iw.n between 1 and 4",
    "op10_streaming_exact_dedup":
        "select doc_id, max(doc_id) over g keep_id, count(*) over g group_size, doc_id = max(doc_id) over g kept, "
        "sha256(coalesce(text, '')) text_sha256 from documents window g as (partition by coalesce(text, ''))",
    "op12_golden_schedule": _mix(),
    "op13_octopus_merkle": _merkle(),
}
