"""Standardisation checks (C1-C11) on dirty text derived from ``orders`` and ``lineitem``."""

from pyspark.sql import functions as F

from recordlake.config import codes
from recordlake.functions import (
    clean_text, clean_upper_text, coerce_double, coerce_long, coerce_timestamp, standardize_pay_unit,
    standardize_status, standardize_visa_class, standardize_yes_no,
)
from recordlake.workloads import _sql as S
from recordlake.workloads._tables import table

STATUS_RAW = [" certified ", "CERTIFIED-EXPIRED", "Certified - Withdrawn", "denied", "PENDING", "",
              "nan", "WITHDRAWN\t", "certified - expired", "Invalidated"]
VISA_RAW = ["R", "A", "S", "C", "H-1B", "nan", " R ", "", "NAN", "E-3"]
UNIT_RAW = ["yr", "HOUR", "bi", "Year", "Yr", "month", "BI-WEEKLY", " wk ", "nan", "mth"]
YESNO_RAW = ["Y", "no", "NO", "1", "0.0", "N/A", "y", " N ", "", "1.0"]
TEXT_RAW_PAD = ["\t{v}", "{v} ", "nan", "NAN", "NULL", "NONE", "", " {v}\t "]


def _pick(idx, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def dirty_orders(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    pad = _pick(k % len(TEXT_RAW_PAD), TEXT_RAW_PAD)
    text = F.replace(pad, F.lit("{v}"), F.col("o_orderpriority"))
    return o.select(
        k.alias("id"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(_pick(k % len(STATUS_RAW), STATUS_RAW)).alias("status_raw"),
        _pick(F.col("o_custkey") % len(VISA_RAW), VISA_RAW).alias("visa_raw"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(_pick((k + 3) % len(UNIT_RAW), UNIT_RAW)).alias("unit_raw"),
        _pick((k + F.col("o_custkey")) % len(YESNO_RAW), YESNO_RAW).alias("yesno_raw"),
        text.alias("text_raw"),
        F.lower(text).alias("lower_raw"))


def q_standardize_codes(spark, d):
    o = dirty_orders(spark, d)
    return o.select(
        "id",
        standardize_status("status_raw").alias("status_lca"),
        standardize_status("status_raw", variant="perm").alias("status_perm"),
        standardize_visa_class("visa_raw").alias("visa_class"),
        standardize_pay_unit("unit_raw").alias("pay_unit"),
        standardize_yes_no("yesno_raw").alias("yes_no"),
        clean_text("text_raw").alias("clean_text"),
        clean_upper_text("lower_raw").alias("upper_text"))


def _sql_dirty():
    k = "o_orderkey"
    pad = S.pick(f"{k} % {len(TEXT_RAW_PAD)}", TEXT_RAW_PAD)
    text = f"replace({pad}, '{{v}}', o_orderpriority)"
    return f"""
    SELECT {k} AS id,
      CASE WHEN {k} % 13 = 0 THEN NULL ELSE {S.pick(f'{k} % {len(STATUS_RAW)}', STATUS_RAW)} END AS status_raw,
      {S.pick(f'o_custkey % {len(VISA_RAW)}', VISA_RAW)} AS visa_raw,
      CASE WHEN {k} % 11 = 0 THEN NULL ELSE {S.pick(f'({k} + 3) % {len(UNIT_RAW)}', UNIT_RAW)} END AS unit_raw,
      {S.pick(f'({k} + o_custkey) % {len(YESNO_RAW)}', YESNO_RAW)} AS yesno_raw,
      {text} AS text_raw, lower({text}) AS lower_raw
    FROM orders"""


def _sql_codes():
    up = f"upper({S.strip('status_raw')})"
    txt = S.strip("text_raw")
    upl = f"upper({S.strip('lower_raw')})"
    return f"""
    WITH o AS ({_sql_dirty()})
    SELECT id,
      {S.recode(up, codes.STATUS_MAP_LCA, codes.STATUS_NULLS)} AS status_lca,
      {S.recode(up, codes.STATUS_MAP_PERM, codes.STATUS_NULLS)} AS status_perm,
      {S.recode(S.strip('visa_raw'), codes.VISA_CLASS_MAP, codes.VISA_CLASS_NULLS)} AS visa_class,
      {S.recode(S.strip('unit_raw'), codes.PAY_UNIT_MAP, codes.PAY_UNIT_NULLS)} AS pay_unit,
      {S.recode(S.strip('yesno_raw'), codes.YES_NO_MAP, codes.YES_NO_NULLS)} AS yes_no,
      CASE WHEN {txt} IN ('nan', 'NAN', '') THEN NULL ELSE {txt} END AS clean_text,
      CASE WHEN {upl} IN ('NAN', '') THEN NULL ELSE {upl} END AS upper_text
    FROM o"""


# ---- C6: dates in several text shapes plus junk

DATE_SHAPES = 13


def q_coerce_timestamp(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey") % DATE_SHAPES
    ts = F.col("o_orderdate")
    raw = (F.when(k == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
           .when(k == 1, F.date_format(ts, "yyyy-MM-dd"))
           .when(k == 2, F.date_format(ts, "M/d/yyyy"))
           .when(k == 3, F.concat(F.lit(" "), F.date_format(ts, "MM/dd/yyyy"), F.lit(" ")))
           .when(k == 4, F.concat(F.lit("x"), F.date_format(ts, "yyyyMMdd")))
           .when(k == 6, F.date_format(ts, "yyyy-MM-dd 00:00:00.5"))
           .when(k == 7, F.date_format(ts, "M/d/yy"))
           .when(k == 8, F.date_format(ts, "yyyy/MM/dd"))
           .when(k == 9, F.concat(F.date_format(ts, "M/d/yyyy"), F.lit(" 3:15 PM")))
           .when(k == 10, F.date_format(ts, "MMM d, yyyy"))
           .when(k == 11, F.date_format(ts, "yyyyMMdd"))
           .when(k == 12, F.date_format(ts, "MMMM d, yyyy"))
           .otherwise(F.col("o_custkey").cast("string")))
    return o.select(F.col("o_orderkey").alias("id"), raw.alias("raw"), coerce_timestamp(raw).alias("parsed"))


SQL_COERCE_TIMESTAMP = f"""
WITH r AS (
  SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, o_orderkey % {DATE_SHAPES} AS k,
    CASE o_orderkey % {DATE_SHAPES}
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%Y')
      WHEN 3 THEN ' ' || strftime(o_orderdate, '%m/%d/%Y') || ' '
      WHEN 4 THEN 'x' || strftime(o_orderdate, '%Y%m%d')
      WHEN 6 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00.5'
      WHEN 7 THEN strftime(o_orderdate, '%-m/%-d/%y')
      WHEN 8 THEN strftime(o_orderdate, '%Y/%m/%d')
      WHEN 9 THEN strftime(o_orderdate, '%-m/%-d/%Y') || ' 3:15 PM'
      WHEN 10 THEN strftime(o_orderdate, '%b %-d, %Y')
      WHEN 11 THEN strftime(o_orderdate, '%Y%m%d')
      WHEN 12 THEN strftime(o_orderdate, '%B %-d, %Y')
      ELSE CAST(o_custkey AS VARCHAR) END AS raw
  FROM orders)
SELECT id, raw,
  CASE WHEN k = 6 THEN day + INTERVAL 500 MILLISECOND
       WHEN k = 9 THEN day + INTERVAL '15 hours 15 minutes'
       WHEN k IN (7, 8, 10, 11, 12) THEN day
       WHEN regexp_matches(raw, '^\\s*\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}( \\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}})?\\s*$')
         THEN CAST(trim(raw) AS TIMESTAMP)
       WHEN regexp_matches(raw, '^\\s*\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}\\s*$')
         THEN strptime(trim(raw), '%m/%d/%Y')
  END AS parsed
FROM r
"""


# ---- C7/C8: numbers in several text shapes

NUM_SHAPES = 10


def _num_raw(x, n):
    """x: double column, n: integer column; shape by a key modulo."""
    return [
        x.cast("string"),
        F.concat(F.lit("1,"), n.cast("string")),
        F.concat(F.lit("$"), n.cast("string")),
        F.concat(n.cast("string"), F.lit(" - "), (n + 1).cast("string")),
        F.concat(F.lit(" "), n.cast("string"), F.lit(".5 ")),
        F.concat(n.cast("string"), F.lit("e2")),
        F.concat(n.cast("string"), F.lit("d")),
        F.concat(F.lit("1_"), n.cast("string")),
        F.lit("1e400"),
        F.concat(F.lit("."), n.cast("string")),
    ]


def q_coerce_numbers(spark, d):
    li = table(spark, d, "lineitem")
    k = (F.col("l_orderkey") + F.col("l_linenumber")) % NUM_SHAPES
    shapes = _num_raw(F.col("l_extendedprice"), F.col("l_linenumber"))
    raw = F.when(k == 0, shapes[0])
    for i in range(1, NUM_SHAPES):
        raw = raw.when(k == i, shapes[i])
    qty = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.floor("l_quantity").cast("long").cast("string"), F.lit(".5"))) \
        .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit(" "), F.floor("l_quantity").cast("long").cast("string"), F.lit(".0"))) \
        .otherwise(F.floor("l_quantity").cast("long").cast("string"))
    return li.select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"),
                     raw.alias("raw"), coerce_double(raw).alias("as_double"),
                     qty.alias("qty_raw"), coerce_long(qty, on_fraction="null").alias("as_long"))


_NUM_OK = "'^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$'"
SQL_COERCE_NUMBERS = f"""
WITH r AS (
  SELECT l_orderkey AS orderkey, l_linenumber AS linenumber,
    CASE (l_orderkey + l_linenumber) % {NUM_SHAPES}
      WHEN 0 THEN CAST(l_extendedprice AS VARCHAR)
      WHEN 1 THEN '1,' || l_linenumber
      WHEN 2 THEN '$' || l_linenumber
      WHEN 3 THEN l_linenumber || ' - ' || (l_linenumber + 1)
      WHEN 4 THEN ' ' || l_linenumber || '.5 '
      WHEN 5 THEN l_linenumber || 'e2'
      WHEN 6 THEN l_linenumber || 'd'
      WHEN 7 THEN '1_' || l_linenumber
      WHEN 8 THEN '1e400'
      ELSE '.' || l_linenumber END AS raw,
    CASE WHEN l_linenumber % 3 = 0 THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '.5'
         WHEN l_linenumber % 3 = 1 THEN ' ' || CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '.0'
         ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END AS qty_raw
  FROM lineitem),
p AS (
  SELECT *,
    CASE WHEN regexp_matches(raw, {_NUM_OK}) THEN TRY_CAST(trim(raw) AS DOUBLE) END AS d0,
    CASE WHEN regexp_matches(qty_raw, {_NUM_OK}) THEN TRY_CAST(trim(qty_raw) AS DOUBLE) END AS q0
  FROM r)
SELECT orderkey, linenumber, raw,
  CASE WHEN isinf(d0) OR isnan(d0) THEN NULL ELSE d0 END AS as_double,
  qty_raw,
  CASE WHEN q0 = floor(q0) AND abs(q0) < 9.223372036854775807e18 THEN CAST(q0 AS BIGINT) END AS as_long
FROM p
"""

QUERIES = {
    "standardize_codes": q_standardize_codes,
    "coerce_timestamp": q_coerce_timestamp,
    "coerce_numbers": q_coerce_numbers,
}
ORACLE = {
    "standardize_codes": _sql_codes(),
    "coerce_timestamp": SQL_COERCE_TIMESTAMP,
    "coerce_numbers": SQL_COERCE_NUMBERS,
}
