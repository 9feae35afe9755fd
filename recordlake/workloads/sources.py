"""File-source checks (S1-S9, K1-K3) on vintages of ``orders`` and ``events``
written to the shared folder and scanned back."""

import warnings

from pyspark.sql import functions as F

from recordlake.config.nulls import PANDAS_DEFAULT_NA_TOKENS
from recordlake.operators.headers import resolve_names
from recordlake.plans._common import harmonized_union, main_files
from recordlake.session import staging_path
from recordlake.sources.files import filter_companion_files, pick_main_file, scan_text_csv
from recordlake.sources.sinks import write_csv, write_parquet
from recordlake.workloads import _sql as S
from recordlake.workloads._tables import table
from recordlake.workloads.harmonise import CANON, SQL_HARMONIZE, orders_vintages


def stage_orders_vintages(spark, d, root):
    """Write the three header eras as files: CSV, CSV + Parquet sibling, Parquet,
    plus a companion file that must be skipped."""
    (y1, v1), (y2, v2), (y3, v3) = orders_vintages(spark, d)
    write_csv(v1, f"{root}/{y1}/LCA_Disclosure_FY{y1}.csv")
    write_csv(v1, f"{root}/{y1}/LCA_FY{y1}_Appendix_A.csv")
    write_csv(v2, f"{root}/{y2}/LCA_Disclosure_FY{y2}.csv")
    write_parquet(v3, f"{root}/{y3}/LCA_Disclosure_FY{y3}.parquet")
    write_csv(v3, f"{root}/{y3}/LCA_Worksites_FY{y3}.csv")
    return root


def q_vintage_scan(spark, d):
    """S1 -> S4 (land CSV as text Parquet, one job per header) -> S5 -> S7 -> read vintages as text, one scan per
    header -> harmonise -> align -> union."""
    root = stage_orders_vintages(spark, d, staging_path(spark, "vintages"))
    files = main_files(spark, root, filter_companion_files)
    return harmonized_union(spark, files, CANON, resolve_names()).drop("_ord")


def q_source_fallback_unreadable(spark, d):
    """A vintage whose Parquet file is damaged is loaded from its CSV sibling, with a warning."""
    root = stage_orders_vintages(spark, d, staging_path(spark, "vintages"))
    y2 = orders_vintages(spark, d)[1][0]
    table(spark, d, "region").select("r_name").write.text(f"{root}/{y2}/LCA_Disclosure_FY{y2}.parquet")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        files = main_files(spark, root, filter_companion_files, land=False, check_rows=True)
    return harmonized_union(spark, files, CANON, resolve_names()).drop("_ord")


def q_scan_text_csv(spark, d):
    """S3 + C11: CSV with pandas-style null tokens read back as text."""
    e = table(spark, d, "events")
    tokens = list(PANDAS_DEFAULT_NA_TOKENS) + ["NAN", "NONE", "na", "-", " "]
    tok = F.element_at(F.array(*[F.lit(t) for t in tokens]), (F.col("event_id") % len(tokens) + 1).cast("int"))
    df = e.select(F.col("event_id").cast("string").alias("event_id"),
                  F.when(F.col("event_id") % 3 == 0, tok).otherwise(F.col("event_type")).alias("Status"),
                  F.col("props").alias("props"))
    path = staging_path(spark, "tokens")
    write_csv(df, path)
    return scan_text_csv(spark, path, usecols=["event_id", "Status"])


SQL_SCAN_TEXT = f"""
WITH t AS (SELECT event_id, CASE WHEN event_id % 3 = 0
                  THEN {S.pick(f'event_id % {len(PANDAS_DEFAULT_NA_TOKENS) + 5}', list(PANDAS_DEFAULT_NA_TOKENS) + ['NAN', 'NONE', 'na', '-', ' '])}
                  ELSE event_type END AS s FROM events)
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN s IN ({', '.join(S.q(t) for t in PANDAS_DEFAULT_NA_TOKENS)}) THEN NULL ELSE s END AS Status
FROM t
"""

# S6 listing: one candidate file per nation row, about three per year folder
NAMES = ["PW_Disclosure_Data_FY{y}", "PW_Disclosure_Data_FY{y}_new_form", "PW_Disclosure_Data_FY{y}_old",
         "pw_{y}_summary", "PW_Disclosure_Data_FY{y}_Revised_Form", "PW_{y}"]
EXTS = [".parquet", ".xlsx", ".csv"]


def _listing(spark, d):
    n = table(spark, d, "nation")
    y = (2010 + F.col("n_nationkey") % 9).cast("string")
    name = F.replace(F.element_at(F.array(*[F.lit(x) for x in NAMES]),
                                  ((F.floor(F.col("n_nationkey") / 9) + F.col("n_regionkey")) % len(NAMES) + 1).cast("int")),
                     F.lit("{y}"), y)
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTS]),
                       ((F.col("n_nationkey") + F.col("n_regionkey")) % len(EXTS) + 1).cast("int"))
    return n.select(y.alias("year"), F.concat(name, ext).alias("file_name"), ext.alias("extension")).distinct()


def q_pick_main_file(spark, d):
    return pick_main_file(_listing(spark, d)).select("year", "file_name", "extension")


_Y = "CAST(2010 + n_nationkey % 9 AS VARCHAR)"
_EXT = S.pick(f"(n_nationkey + n_regionkey) % {len(EXTS)}", EXTS)
SQL_PICK = f"""
WITH f AS (
  SELECT DISTINCT {_Y} AS year,
         replace({S.pick(f'(floor(n_nationkey / 9) + n_regionkey) % {len(NAMES)}', NAMES)}, '{{y}}', {_Y}) || {_EXT} AS file_name,
         {_EXT} AS extension
  FROM nation),
e AS (SELECT *, CASE extension WHEN '.parquet' THEN 0 WHEN '.xlsx' THEN 1 END AS ext_rank FROM f),
c AS (SELECT *, count(*) OVER (PARTITION BY year, ext_rank) AS n_ext,
             sum(CASE WHEN contains(file_name, 'Disclosure_Data') THEN 1 ELSE 0 END) OVER (PARTITION BY year, ext_rank) AS n_marker
      FROM e WHERE ext_rank IS NOT NULL),
r AS (SELECT *, CASE WHEN n_ext = 1 THEN 0
                     WHEN contains(file_name, 'Disclosure_Data') AND n_marker = 1 THEN 1
                     WHEN contains(file_name, 'Disclosure_Data') AND (contains(lower(file_name), 'new_form')
                          OR contains(lower(file_name), 'revised_form')) THEN 2
                     WHEN contains(file_name, 'Disclosure_Data') THEN 3 END AS rule FROM c)
SELECT year, file_name, extension FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY ext_rank, rule, file_name) AS rn FROM r WHERE rule IS NOT NULL)
WHERE rn = 1
"""

QUERIES = {"vintage_scan": q_vintage_scan, "source_fallback_unreadable": q_source_fallback_unreadable, "scan_text_csv": q_scan_text_csv, "pick_main_file": q_pick_main_file}
ORACLE = {"vintage_scan": SQL_HARMONIZE, "source_fallback_unreadable": SQL_HARMONIZE, "scan_text_csv": SQL_SCAN_TEXT, "pick_main_file": SQL_PICK}
