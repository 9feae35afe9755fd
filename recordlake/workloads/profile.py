"""Profiling checks (P1-P8) on ``lineitem``, ``orders`` and ``events``."""

from pyspark.sql import functions as F

from recordlake.operators.profile import (
    date_range, files_per_program, frequencies_by_key_order, null_percentages, outcome_counts,
    program_change_flags, run_counts, value_frequencies,
)
from recordlake.workloads._tables import table


def _flags(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_returnflag")).alias("status"),
        "l_linestatus", F.date_format("l_shipdate", "yyyy").alias("fiscal_year"))


def q_run_counts(spark, d):
    before = _flags(spark, d)
    return run_counts(before, before.distinct())


SQL_RUN_COUNTS = """
WITH f AS (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS status, l_linestatus,
                  strftime(l_shipdate, '%Y') AS fiscal_year FROM lineitem)
SELECT (SELECT count(*) FROM f) AS rows_before, (SELECT count(*) FROM (SELECT DISTINCT * FROM f)) AS rows_after,
       3 AS columns_before, 3 AS columns_after,
       (SELECT count(*) FROM f) - (SELECT count(*) FROM (SELECT DISTINCT * FROM f)) AS rows_removed
"""


def q_date_range(spark, d):
    return date_range(table(spark, d, "lineitem"), "l_shipdate")


SQL_DATE_RANGE = "SELECT min(l_shipdate) AS min_value, max(l_shipdate) AS max_value FROM lineitem"


def q_value_frequencies(spark, d):
    e = table(spark, d, "events")
    v = e.select(F.when(F.col("user_id") % 9 == 0, F.lit(None)).otherwise(
        F.concat(F.col("event_type"), F.lit("-"), (F.col("user_id") % 5).cast("string"))).alias("v"))
    return value_frequencies(v, "v", top=10)


SQL_VALUE_FREQ = """
SELECT v AS value, count(*) AS count FROM (
  SELECT CASE WHEN user_id % 9 = 0 THEN NULL ELSE event_type || '-' || CAST(user_id % 5 AS VARCHAR) END AS v FROM events)
WHERE v IS NOT NULL GROUP BY v ORDER BY count DESC, value LIMIT 10
"""


def q_frequencies_by_key_order(spark, d):
    return frequencies_by_key_order(_flags(spark, d), "fiscal_year")


SQL_FREQ_KEY = """
SELECT strftime(l_shipdate, '%Y') AS value, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 1
"""


def q_null_percentages(spark, d):
    e = table(spark, d, "events")
    v = e.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(F.col("user_id") % 4 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"),
        F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("ts")).alias("ts"))
    out = null_percentages(v)
    return out.select("position", "column_name", F.round("null_pct", 6).alias("null_pct"))


SQL_NULL_PCT = """
WITH v AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
                  CASE WHEN user_id % 4 = 0 THEN NULL ELSE props END AS props,
                  CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS ts FROM events)
SELECT * FROM (
  SELECT 0 AS position, 'event_id' AS column_name, round(avg(CASE WHEN event_id IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS null_pct FROM v
  UNION ALL SELECT 1, 'value', round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) FROM v
  UNION ALL SELECT 2, 'props', round(avg(CASE WHEN props IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) FROM v
  UNION ALL SELECT 3, 'ts', round(avg(CASE WHEN ts IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) FROM v)
ORDER BY null_pct DESC, position
"""

# events as fetch outcomes: nothing maps to skipped_hash, so a zero row shows
_OUTCOME = {"view": "downloaded", "click": "skipped_etag", "signup": "skipped_lastmod", "error": "failed",
            "purchase": "failed"}
_PROGRAMS = ["LCA Program", "PERM Program", "Prevailing Wage Program", "H-2A Program"]


def _outcomes(spark, d):
    e = table(spark, d, "events")
    st = F.col("event_type")
    m = None
    for k, v in _OUTCOME.items():
        m = F.when(st == k, v) if m is None else m.when(st == k, v)
    prog = F.element_at(F.array(*[F.lit(p) for p in _PROGRAMS]), (F.col("user_id") % 4 + 1).cast("int"))
    out = e.select("event_id", m.alias("status"), prog.alias("program"))
    return out.withColumn("is_new", (F.col("status") == "downloaded") & (F.col("event_id") % 7 == 0)
                          & (F.col("program") != "Prevailing Wage Program"))


def q_outcome_counts(spark, d):
    return outcome_counts(_outcomes(spark, d))


def _sql_outcomes():
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _OUTCOME.items())
    progs = ", ".join(f"'{p}'" for p in _PROGRAMS)
    return f"""SELECT event_id, CASE event_type {cases} END AS status,
        ([{progs}])[CAST(user_id % 4 + 1 AS INTEGER)] AS program FROM events"""


SQL_OUTCOMES = f"""
WITH o AS ({_sql_outcomes()}),
s AS (SELECT * FROM (VALUES ('downloaded'), ('skipped_etag'), ('skipped_lastmod'), ('skipped_hash'), ('failed')) t(status))
SELECT s.status, CAST(count(o.event_id) AS BIGINT) AS n_files FROM s LEFT JOIN o ON o.status = s.status GROUP BY s.status
"""


def q_program_change_flags(spark, d):
    return program_change_flags(_outcomes(spark, d))


SQL_FLAGS = f"""
WITH o AS (SELECT *, status = 'downloaded' AND event_id % 7 = 0 AND program <> 'Prevailing Wage Program' AS is_new
           FROM ({_sql_outcomes()}))
SELECT COALESCE(bool_or(program = 'LCA Program' AND is_new), false) AS lca,
       COALESCE(bool_or(program = 'PERM Program' AND is_new), false) AS perm,
       COALESCE(bool_or(program = 'Prevailing Wage Program' AND is_new), false) AS pw
FROM o
"""


def q_files_per_program(spark, d):
    return files_per_program(_outcomes(spark, d))


SQL_FILES_PER_PROGRAM = f"""
SELECT program, count(*) AS n_files FROM ({_sql_outcomes()}) GROUP BY program
"""

QUERIES = {
    "run_counts": q_run_counts,
    "date_range": q_date_range,
    "value_frequencies": q_value_frequencies,
    "frequencies_by_key_order": q_frequencies_by_key_order,
    "null_percentages": q_null_percentages,
    "outcome_counts": q_outcome_counts,
    "program_change_flags": q_program_change_flags,
    "files_per_program": q_files_per_program,
}
ORACLE = {
    "run_counts": SQL_RUN_COUNTS,
    "date_range": SQL_DATE_RANGE,
    "value_frequencies": SQL_VALUE_FREQ,
    "frequencies_by_key_order": SQL_FREQ_KEY,
    "null_percentages": SQL_NULL_PCT,
    "outcome_counts": SQL_OUTCOMES,
    "program_change_flags": SQL_FLAGS,
    "files_per_program": SQL_FILES_PER_PROGRAM,
}
