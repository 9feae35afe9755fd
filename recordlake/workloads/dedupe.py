"""Dedupe checks (U2, U3, D1-D4, A1) on ``events``, ``documents``, ``pages``, ``orders``."""

import uuid

from pyspark.sql import functions as F

from recordlake.functions import normalize_url
from recordlake.operators.dedupe import (
    anti_join_seen, batch_of, dedupe_by_priority, dedupe_first_batch, dedupe_keep_first, distinct_rows,
    normalize_key_strip_upper, normalize_key_upper,
)
from recordlake.operators.ledger import anti_join_ledger, append_keys
from recordlake.session import staging_path
from recordlake.workloads._tables import table


def _event_keys(spark, d):
    """Case keys with padding/case drift; every 50th key missing."""
    e = table(spark, d, "events")
    base = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), F.col("event_type"))
    m = F.col("event_id") % 3
    raw = (F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("string"))
           .when(m == 0, F.concat(F.lit(" "), base, F.lit(" ")))
           .when(m == 1, F.upper(base))
           .otherwise(base))
    return e.select("event_id", "ts", "user_id", "event_type", "value", raw.alias("case_number"))


def q_dedupe_keep_first(spark, d):
    """U3 + D1 (permanent-program rule): upper without strip, null -> NONE, first by event_id."""
    e = _event_keys(spark, d).withColumn("case_number", normalize_key_upper(F.col("case_number")))
    return dedupe_keep_first(e, "case_number", [F.col("event_id")])


SQL_KEEP_FIRST = """
WITH k AS (
  SELECT event_id, ts, user_id, event_type, value,
    COALESCE(upper(CASE WHEN event_id % 50 = 0 THEN NULL
                        WHEN event_id % 3 = 0 THEN ' ' || 'u' || user_id || '_' || event_type || ' '
                        WHEN event_id % 3 = 1 THEN upper('u' || user_id || '_' || event_type)
                        ELSE 'u' || user_id || '_' || event_type END), 'NONE') AS case_number
  FROM events)
SELECT event_id, ts, user_id, event_type, value, case_number FROM (
  SELECT *, row_number() OVER (PARTITION BY case_number ORDER BY event_id) AS rn FROM k) WHERE rn = 1
"""


def q_dedupe_first_batch(spark, d):
    """U2 + D2 (labour-condition rule): strip+upper keys, 2,000-row batches by
    event_id; a row survives iff its key is in no earlier batch."""
    e = _event_keys(spark, d).withColumn("case_number", normalize_key_strip_upper(F.col("case_number")))
    e = e.withColumn("batch", batch_of(F.col("event_id"), 2000))
    return dedupe_first_batch(e, "case_number", "batch")


SQL_FIRST_BATCH = """
WITH k AS (
  SELECT event_id, ts, user_id, event_type, value,
    COALESCE(upper(trim(CASE WHEN event_id % 50 = 0 THEN NULL
                        WHEN event_id % 3 = 0 THEN ' ' || 'u' || user_id || '_' || event_type || ' '
                        WHEN event_id % 3 = 1 THEN upper('u' || user_id || '_' || event_type)
                        ELSE 'u' || user_id || '_' || event_type END)), 'NONE') AS case_number,
    CAST(floor(event_id / 2000) AS BIGINT) AS batch
  FROM events)
SELECT event_id, ts, user_id, event_type, value, case_number, batch FROM (
  SELECT *, min(batch) OVER (PARTITION BY case_number) AS mb FROM k) WHERE batch = mb
"""


def q_distinct_rows(spark, d):
    """D3 on (lang, source, text-length bucket) of documents plus exact texts."""
    doc = table(spark, d, "documents")
    return distinct_rows(doc.select("lang", "source", "text"))


SQL_DISTINCT = "SELECT DISTINCT lang, source, text FROM documents"


def _url_variants(spark, d):
    """Two sections of candidate URLs: the page URLs as given (section 0) and
    drifted spellings of the same URLs (section 1: case, trailing slash, fragment)."""
    p = table(spark, d, "pages").select("page_id", "url")
    m = F.col("page_id") % 4
    drift = (F.when(m == 0, F.upper(F.col("url")))
             .when(m == 1, F.regexp_replace("url", r"^(https?://[^?#]*)", "$1/"))
             .when(m == 2, F.concat(F.col("url"), F.lit("#frag")))
             .otherwise(F.concat(F.lit("  "), F.col("url"))))
    a = p.select("page_id", F.col("url").alias("raw_url"), F.lit(1).alias("section"), F.lit(0).alias("pos"))
    b = p.select("page_id", drift.alias("raw_url"), F.lit(0).alias("section"), F.col("page_id").alias("pos"))
    return a.unionByName(b)


def q_dedupe_by_url_priority(spark, d):
    c = _url_variants(spark, d).withColumn("url", normalize_url(F.col("raw_url")))
    return dedupe_by_priority(c, "url", [F.col("section"), F.col("pos"), F.col("page_id")])


_U = "regexp_replace(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '[\\t\\r\\n]', '', 'g')"
_RFC = "'^(?:([A-Za-z][A-Za-z0-9+.\\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$'"


def sql_normalize_url(x: str) -> str:
    u = _U.format(x=x)
    g = lambda i: f"regexp_extract({u}, {_RFC}, {i})"
    return (f"(CASE WHEN {g(1)} <> '' THEN lower({g(1)}) || ':' ELSE '' END"
            f" || CASE WHEN {g(2)} <> '' THEN '//' || lower({g(2)}) ELSE '' END"
            f" || regexp_replace({g(3)}, '/+$', '')"
            f" || CASE WHEN {g(4)} <> '' THEN '?' || {g(4)} ELSE '' END)")


SQL_URL_PRIORITY = f"""
WITH p AS (SELECT page_id, url FROM pages),
c AS (
  SELECT page_id, url AS raw_url, 1 AS section, 0 AS pos FROM p
  UNION ALL
  SELECT page_id,
    CASE page_id % 4 WHEN 0 THEN upper(url)
                     WHEN 1 THEN regexp_replace(url, '^(https?://[^?#]*)', '\\1/')
                     WHEN 2 THEN url || '#frag'
                     ELSE '  ' || url END,
    0, page_id FROM p),
n AS (SELECT *, {sql_normalize_url('raw_url')} AS url FROM c)
SELECT page_id, raw_url, section, pos, url FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY section, pos, page_id) AS rn FROM n) WHERE rn = 1
"""


def q_anti_join_seen(spark, d):
    """A1: customers not yet seen among the keys already loaded (orders before 1996)."""
    c = table(spark, d, "customer")
    seen = (table(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp"))
            .select(F.col("o_custkey").alias("c_custkey")))
    return anti_join_seen(c, seen, "c_custkey")


def q_anti_join_ledger(spark, d):
    """A1 through a bucketed key ledger that two loads have filled: customers of neither, and of the second load's
    rows only those that the first had not entered."""
    orders = table(spark, d, "orders")
    keys = orders.select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"))
    name = f"ledger_{uuid.uuid4().hex[:10]}"
    append_keys(keys.where("y < 1995"), name, "c_custkey", staging_path(spark, "ledger"), buckets=8)
    append_keys(keys.where("y = 1995"), name, "c_custkey", buckets=8)
    left = anti_join_ledger(table(spark, d, "customer"), name, "c_custkey").withColumn("entries", F.lit(0).cast("long"))
    entered = spark.table(name).groupBy("c_custkey").agg(F.count("*").alias("entries"))
    seen = table(spark, d, "customer").join(entered, "c_custkey")
    return left.unionByName(seen.select(*left.columns))


SQL_ANTI_LEDGER = """
SELECT c.*, CAST(CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) <= 1995)
                      THEN 1 ELSE 0 END AS BIGINT) AS entries FROM customer c
"""


SQL_ANTI = """
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate < TIMESTAMP '1996-01-01')
"""

QUERIES = {
    "dedupe_keep_first": q_dedupe_keep_first,
    "dedupe_first_batch": q_dedupe_first_batch,
    "distinct_rows": q_distinct_rows,
    "dedupe_by_url_priority": q_dedupe_by_url_priority,
    "anti_join_seen": q_anti_join_seen,
    "anti_join_ledger": q_anti_join_ledger,
}
ORACLE = {
    "dedupe_keep_first": SQL_KEEP_FIRST,
    "dedupe_first_batch": SQL_FIRST_BATCH,
    "distinct_rows": SQL_DISTINCT,
    "dedupe_by_url_priority": SQL_URL_PRIORITY,
    "anti_join_seen": SQL_ANTI,
    "anti_join_ledger": SQL_ANTI_LEDGER,
}
