"""Path-layout and sink checks (L1-L5, K2-K6) on ``pages``, ``nation``, ``events`` and ``orders``."""

import uuid

from pyspark.sql import functions as F

from recordlake.functions import (
    annual_path, monthly_path, program_year_path, sanitize_name, strip_uri_prefix, visa_year_path,
)
from recordlake.operators.manifest import SUMMARY_SCHEMA, change_status, create_manifest_table, run_summary
from recordlake.session import staging_path
from recordlake.sources.files import scan_text_csv
from recordlake.sources.sinks import (
    append_table, write_csv, write_json_summary, write_parquet, write_partitioned_layout, write_report_csv,
)
from recordlake.workloads._tables import table
from recordlake.workloads.harmonise import SQL_UNMAPPED, q_unmapped_column_report
from recordlake.workloads.manifest import RUN_TIME, SQL_SUMMARY, _observations_and_manifest

ROOT = "dbfs:/FileStore/records"


def q_path_expressions(spark, d):
    """L1-L4 over page URLs (unsafe characters, long names) and nation names."""
    p = table(spark, d, "pages")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = p.join(n, (p["page_id"] % 25) == n["n_nationkey"])
    period = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("FY"), (2000 + F.col("page_id") % 25).cast("string"),
                                                          F.lit("-"), F.lpad((F.col("page_id") % 12 + 1).cast("string"), 2, "0")))\
        .otherwise(F.concat(F.lit("M"), F.col("page_id").cast("string")))
    year = (2000 + F.col("page_id") % 25).cast("string")
    uri = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(ROOT + "/"), F.col("n_name")))\
        .otherwise(F.concat(F.lit("/local/"), F.col("n_name")))
    return j.select(
        "page_id",
        strip_uri_prefix(uri).alias("local_path"),
        sanitize_name(F.col("url")).alias("safe_url"),
        monthly_path(F.lit(ROOT + "/visa_stats"), F.col("n_name"), period).alias("monthly"),
        annual_path(F.lit(ROOT + "/visa_stats"), year).alias("annual"),
        program_year_path(F.lit(ROOT + "/performance_data"), F.concat(F.col("n_name"), F.lit(" Program/x")), year).alias("program_dir"),
        visa_year_path(F.lit(ROOT + "/uscis_data"), F.lower("n_name"), year).alias("visa_dir"))


SQL_PATHS = f"""
WITH j AS (
  SELECT p.page_id, p.url, n.n_name,
         CASE WHEN p.page_id % 3 = 0 THEN 'FY' || (2000 + p.page_id % 25) || '-' || lpad(CAST(p.page_id % 12 + 1 AS VARCHAR), 2, '0')
              ELSE 'M' || p.page_id END AS period,
         CAST(2000 + p.page_id % 25 AS VARCHAR) AS year,
         CASE WHEN p.page_id % 2 = 0 THEN '{ROOT}/' || n.n_name ELSE '/local/' || n.n_name END AS uri
  FROM pages p JOIN nation n ON p.page_id % 25 = n.n_nationkey)
SELECT page_id,
  regexp_replace(uri, '^dbfs:/', '/dbfs/') AS local_path,
  substring(regexp_replace(regexp_replace(url, '^\\s+|\\s+$', '', 'g'), '[\\\\/*?:"<>|]', '_', 'g'), 1, 80) AS safe_url,
  CASE WHEN regexp_extract(period, '^(FY\\d{{4}})', 1) <> ''
       THEN '{ROOT}/visa_stats/monthly/' || n_name || '/' || regexp_extract(period, '^(FY\\d{{4}})', 1) || '/' || period
       ELSE '{ROOT}/visa_stats/monthly/' || n_name || '/' || period END AS monthly,
  '{ROOT}/visa_stats/annual/' || year AS annual,
  '{ROOT}/performance_data/' || substring(regexp_replace(n_name || ' Program/x', '[\\\\/*?:"<>|]', '_', 'g'), 1, 80) || '/' || year AS program_dir,
  '{ROOT}/uscis_data/' || lower(n_name) || '/' || year AS visa_dir
FROM j
"""


def q_partitioned_layout(spark, d):
    """Write orders as {{root}}/{{program}}/{{year}}/..., read back, count per folder."""
    o = table(spark, d, "orders")
    df = o.select("o_orderkey", F.col("o_orderpriority").alias("program"),
                  F.year("o_orderdate").cast("string").alias("year"))
    root = staging_path(spark, "layout")
    write_partitioned_layout(df, root)
    back = spark.read.option("basePath", root).parquet(root)
    return back.groupBy(F.col("program").cast("string").alias("program"), F.col("year").cast("string").alias("year")) \
               .agg(F.count(F.lit(1)).alias("n_rows"))


SQL_PARTITIONED = """
SELECT o_orderpriority AS program, CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n_rows
FROM orders GROUP BY 1, 2
"""

# ---- K2-K6: written in parts, read back whole

def _orders(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("case_number"),
                                            F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(', "x" ')).alias("note"),
                                            F.year("o_orderdate").alias("SOURCE_YEAR"))


def q_append_csv(spark, d):
    """K2: batches appended to one CSV output; each part has the header, none of it is read as a row."""
    path = staging_path(spark, "append")
    o = _orders(spark, d)
    write_csv(o.where("SOURCE_YEAR < 1995"), path)
    write_csv(o.where("SOURCE_YEAR >= 1995"), path, mode="append")
    return scan_text_csv(spark, path, tokens=None)


SQL_APPEND_CSV = """
SELECT CAST(o_orderkey AS VARCHAR) AS case_number, ' ' || o_orderpriority || ', "x" ' AS note,
       CAST(year(o_orderdate) AS VARCHAR) AS SOURCE_YEAR FROM orders
"""


def q_replace_partitions(spark, d):
    """K3: all years written, then the years from 1996 on once more, with other notes."""
    path = staging_path(spark, "years")
    o = _orders(spark, d)
    write_parquet(o, path, partition_by="SOURCE_YEAR")
    again = o.where("SOURCE_YEAR >= 1996").withColumn("note", F.concat(F.lit("again "), "case_number"))
    write_parquet(again, path, partition_by="SOURCE_YEAR", replace_partitions=True)
    return spark.read.parquet(path).select("case_number", "note", "SOURCE_YEAR")


SQL_REPLACE_PARTITIONS = """
SELECT CAST(o_orderkey AS VARCHAR) AS case_number,
       CASE WHEN year(o_orderdate) >= 1996 THEN 'again ' || o_orderkey ELSE ' ' || o_orderpriority || ', "x" ' END AS note,
       CAST(year(o_orderdate) AS INTEGER) AS SOURCE_YEAR FROM orders
"""


def q_write_json_summary(spark, d):
    """K4: the run summary as a JSON document, read back."""
    obs, man = _observations_and_manifest(spark, d)
    path = staging_path(spark, "summary")
    write_json_summary(run_summary(change_status(obs, man), RUN_TIME), path)
    return spark.read.schema(SUMMARY_SCHEMA).json(path)


def q_write_report_csv(spark, d):
    """K5: the report of unmapped columns as CSV, read back."""
    path = staging_path(spark, "report")
    write_report_csv(q_unmapped_column_report(spark, d), path)
    return scan_text_csv(spark, path, tokens=None)


def q_append_table(spark, d):
    """K6: two batches appended to the manifest's catalog table; what they leave out gets the table's defaults."""
    name = f"appended_{uuid.uuid4().hex[:10]}"
    create_manifest_table(spark, name, staging_path(spark, "table"))
    e = table(spark, d, "events")
    rows = e.select(F.lit("records").alias("source_id"), F.lit("monthly").alias("file_type"),
                    F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("period"),
                    F.concat(F.lit("https://h.org/"), F.col("event_id").cast("string")).alias("url"),
                    F.col("event_type").alias("filename"), F.lit("/d").alias("saved_path"), F.col("event_id").alias("bytes"))
    append_table(rows.where("bytes % 2 = 0"), name)
    append_table(rows.where("bytes % 2 = 1"), name)
    return spark.table(name).select("source_id", "period", "url", "filename", "bytes", "version", "status", "etag",
                                    F.col("updated_at").isNotNull().alias("stamped"))


SQL_APPEND_TABLE = """
SELECT 'records' AS source_id, 'P' || user_id AS period, 'https://h.org/' || event_id AS url, event_type AS filename,
       event_id AS bytes, 1 AS version, 'active' AS status, CAST(NULL AS VARCHAR) AS etag, true AS stamped FROM events
"""

QUERIES = {
    "path_expressions": q_path_expressions,
    "partitioned_layout": q_partitioned_layout,
    "append_csv": q_append_csv,
    "replace_partitions": q_replace_partitions,
    "write_json_summary": q_write_json_summary,
    "write_report_csv": q_write_report_csv,
    "append_table": q_append_table,
}
ORACLE = {
    "path_expressions": SQL_PATHS,
    "partitioned_layout": SQL_PARTITIONED,
    "append_csv": SQL_APPEND_CSV,
    "replace_partitions": SQL_REPLACE_PARTITIONS,
    "write_json_summary": SQL_SUMMARY,
    "write_report_csv": f"SELECT COLUMN_NAME, YEARS_APPEARED, CAST(N_VALUES AS VARCHAR) AS N_VALUES FROM ({SQL_UNMAPPED})",
    "append_table": SQL_APPEND_TABLE,
}
