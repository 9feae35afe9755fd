"""Operator 8, licence scan by canonical digests.

DataFrame functions only. Texts are compared whole, after normalisation: lower case,
copyright lines dropped, runs of anything but letters and digits to one space, equivalent
spellings made one. What is looked up is the document, each of its paragraphs (divided by
blank lines) and each of its lines; only texts of a length that some known licence has are
hashed, and their SHA-256 is joined to the table of known digests, whose size is fixed by
``licences`` (a few dozen rows).

Defined cases: a null or empty text has no licence; a text whose lines are all dropped has
none either; a licence found several times is listed once and counted each time (a text that
is a line, a paragraph and the document at once counts once); repeated rows give equal
rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm import licences
from recordlake.llm.common import anchored, col, positioned, stage

COPYRIGHT = r"^[^a-z0-9]*(copyright|\(c\)|©|all rights reserved)"


def canonical_line(line: Column) -> Column:
    """A line's normalised words; empty for a copyright line."""
    low = F.lower(line)
    words = F.split(F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " ")), " ")
    same = F.create_map(*[F.lit(x) for pair in licences.EQUIVALENT.items() for x in pair])
    return F.when(low.rlike(COPYRIGHT), "").otherwise(
        F.array_join(F.transform(words, lambda w: F.coalesce(same[w], w)), " "))


def joined(lines: Column) -> Column:
    """Normalised lines as one text."""
    out = F.concat(F.lit(" "), F.array_join(F.filter(lines, lambda x: x != ""), " "), F.lit(" "))
    for pair, one in licences.JOINED.items():
        out = F.regexp_replace(out, f" {pair}(?= )", f" {one}")
    return F.trim(out)


def paragraphs(text: Column) -> Column:
    """Lists of normalised lines of each paragraph."""
    return F.transform(F.split(text, r"\n[ \t\r]*\n", -1), lambda p: F.transform(F.split(p, "\n", -1), canonical_line))


def known(spark: SparkSession) -> DataFrame:
    """licence, digest, size: the known texts, normalised the same way."""
    rows = [(k, v) for k, v in licences.TEXTS.items()] + [(v, k) for k, v in licences.NOTICES.items()]
    texts = spark.createDataFrame(rows, "licence string, text string")
    one = texts.select("licence", joined(F.flatten(paragraphs(F.col("text")))).alias("t"))
    return one.select("licence", F.sha2("t", 256).alias("digest"), F.length("t").alias("size")).distinct()


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, whole_licence (of the entire text), licences (sorted, comma-joined), n_found: one
    row per row of ``docs``."""
    docs = anchored(docs)
    table = stage(known(docs.sparkSession), "licences")
    sizes = F.array(*[F.lit(r["size"]) for r in table.select("size").distinct().collect()])
    src = positioned(docs, text=F.coalesce(col(text), F.lit("")))
    parts = src.select("fh", "row", paragraphs(F.col("text")).alias("p"))
    whole = parts.select("fh", "row", "p", joined(F.flatten("p")).alias("whole"))
    # a paragraph of one line is that line, a document of one paragraph that paragraph
    lines = F.transform(F.flatten("p"), lambda x: joined(F.array(x)))
    paras = F.transform(F.filter("p", lambda p: F.size(F.filter(p, lambda x: x != "")) > 1), joined)
    more = F.when(F.size(F.filter("p", lambda p: F.exists(p, lambda x: x != ""))) > 1, paras).otherwise(
        F.array().cast("array<string>"))
    single = F.size(F.filter(F.flatten("p"), lambda x: x != "")) == 1
    found = whole.select("fh", "row", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("is_whole"), F.col("whole").alias("t"))),
        F.transform(F.filter(F.when(single, F.array().cast("array<string>")).otherwise(F.concat(more, lines)),
                             lambda t: F.array_contains(sizes, F.length(t))),
                    lambda t: F.struct(F.lit(False).alias("is_whole"), t.alias("t"))))).alias("u"))
    found = found.where(F.array_contains(sizes, F.length("u.t"))).select(
        "fh", "row", "u.is_whole", F.sha2("u.t", 256).alias("digest"))
    hits = found.join(F.broadcast(table.select("digest", "licence")), "digest").groupBy("fh", "row").agg(
        F.max(F.when(F.col("is_whole"), F.col("licence"))).alias("whole_licence"),
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"), F.count("*").alias("n_found"))
    rows = positioned(docs, doc_id=col(doc_id)).join(stage(hits, "hits"), ["fh", "row"], "left")
    return rows.select("doc_id", "whole_licence", F.coalesce("licences", F.lit("")).alias("licences"),
                       F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"))
