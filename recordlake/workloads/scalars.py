"""Single-operator checks of discovery expressions over whole tables and whole texts."""

from pyspark.sql import functions as F

from recordlake.functions import classify_program, normalize_url, skip_deprecated
from recordlake.workloads import _sql as S
from recordlake.workloads._tables import table
from recordlake.workloads.dedupe import sql_normalize_url


def q_normalize_url(spark, d):
    """X8 on every page URL (scheme/host case, trailing slashes, fragments)."""
    p = table(spark, d, "pages")
    return p.select("page_id", "url", normalize_url(F.col("url")).alias("normalized"))


SQL_NORMALIZE_URL = f"SELECT page_id, url, {sql_normalize_url('url')} AS normalized FROM pages"


def q_classify_program(spark, d):
    """X5 with a whole document text as context and its source as the name."""
    doc = table(spark, d, "documents")
    return doc.select("doc_id", classify_program(F.col("source"), F.col("text")).alias("program"))


SQL_CLASSIFY_PROGRAM = f"SELECT doc_id, {S.classify('source', 'text')} AS program FROM documents"


def q_skip_deprecated(spark, d):
    """X4 with a whole document text as context; file names alternate .pdf/.xlsx."""
    doc = table(spark, d, "documents")
    fname = F.concat(F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.lit(".pdf")).otherwise(F.lit(".xlsx")))
    return doc.select("doc_id", skip_deprecated(fname, F.col("text")).alias("skipped"))


SQL_SKIP_DEPRECATED = f"""
SELECT doc_id, {S.skip("source || CASE WHEN doc_id % 2 = 0 THEN '.pdf' ELSE '.xlsx' END", 'text')} AS skipped
FROM documents
"""

QUERIES = {"normalize_url": q_normalize_url, "classify_program": q_classify_program,
           "skip_deprecated": q_skip_deprecated}
ORACLE = {"normalize_url": SQL_NORMALIZE_URL, "classify_program": SQL_CLASSIFY_PROGRAM,
          "skip_deprecated": SQL_SKIP_DEPRECATED}
