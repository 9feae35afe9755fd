"""Header harmonisation checks (H1-H13, H11/H12, U1) on vintages derived from
``orders``, ``part``, ``customer`` and ``supplier``."""

from pyspark.sql import functions as F

from recordlake.operators.align import align_to_schema, stamp_year, union_vintages
from recordlake.operators.headers import (
    alias_sequential_move, harmonize_vintage, mapping_table_rename, select_slots, slots_of, to_positional,
    unmapped_values, detect_form_type, normalize_headers, drop_duplicate_headers,
    drop_all_null_columns, non_null_column_indices, drop_blank_headers,
)
from recordlake.workloads._tables import table

CANON = ["case_number", "case_status", "decision_date", "employer_name", "wage_rate_of_pay_from",
         "worksite_city", "year"]


def orders_vintages(spark, d):
    """Three header eras of ``orders``: up to 1996, 1997-98, from 1999."""
    o = table(spark, d, "orders")
    y = F.year("o_orderdate")
    key = F.col("o_orderkey").cast("string")
    cust = F.col("o_custkey").cast("string")
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    v1 = o.where(y <= 1996).select(
        key.alias(" Case No"), F.col("o_orderstatus").alias("APPROVAL-STATUS"),
        F.col("o_orderpriority").alias("Unnamed: 3"), cust.alias("case no"),
        cust.alias("Name"), cents.alias("Wage Rate 1"), F.col("o_orderpriority").alias("Wage Rate 2"))
    v2 = o.where((y >= 1997) & (y <= 1998)).select(
        key.alias("LCA_CASE_NUMBER"), F.lit(None).cast("string").alias("Status"),
        F.col("o_orderstatus").alias("CASE_STATUS"), F.col("o_orderpriority").alias("STATUS"),
        cust.alias("LCA_CASE_EMPLOYER_NAME"), cents.alias("LCA_CASE_WAGE_RATE_FROM"), day.alias("Decision-Date"))
    v3 = o.where(y >= 1999).select(
        key.alias("case_number"), F.col("o_orderstatus").alias("case_status"), cust.alias("employer_name"),
        cents.alias("wage_rate_of_pay_from"), day.alias("decision_date"),
        F.col("o_orderpriority").alias("worksite_city_1"), F.col("o_orderstatus").alias("worksite_city_2"),
        F.col("o_orderpriority").alias("city_2"), F.lit("x").alias("year"))
    return [("1996", v1), ("1998", v2), ("2001", v3)]


def q_harmonize_vintages(spark, d):
    frames = [align_to_schema(stamp_year(harmonize_vintage(v), label), CANON) for label, v in orders_vintages(spark, d)]
    return union_vintages(frames)


_CENTS = "CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) AS VARCHAR)"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
SQL_HARMONIZE = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS case_number, o_orderstatus AS case_status,
       CAST(NULL AS VARCHAR) AS decision_date, CAST(o_custkey AS VARCHAR) AS employer_name,
       {_CENTS} AS wage_rate_of_pay_from, CAST(NULL AS VARCHAR) AS worksite_city, '1996' AS year
FROM orders WHERE year(o_orderdate) <= 1996
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, {_DAY}, CAST(o_custkey AS VARCHAR), {_CENTS},
       CAST(NULL AS VARCHAR), '1998'
FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1998
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, {_DAY}, CAST(o_custkey AS VARCHAR), {_CENTS},
       o_orderpriority, '2001'
FROM orders WHERE year(o_orderdate) >= 1999
"""


def q_drop_all_null_columns(spark, d):
    """H1 -> H2 -> H3 -> H4 on every vintage, without aliasing: of 1997-98 the all-null ``Status``
    goes, the duplicate ``STATUS`` went before the test. Columns of all vintages side by side."""
    frames = []
    for label, v in orders_vintages(spark, d):
        slots = drop_duplicate_headers(normalize_headers(slots_of(v.columns)))
        slots = drop_blank_headers(drop_all_null_columns(slots, non_null_column_indices(v)))
        frames.append(stamp_year(select_slots(to_positional(v), slots), label))
    names = list(dict.fromkeys(c for f in frames for c in f.columns))
    return union_vintages([align_to_schema(f, names) for f in frames])


_KEY, _CUST = "CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)"
SQL_DROP_ALL_NULL = f"""
SELECT {_KEY} AS case_no, o_orderstatus AS approval_status, {_CUST} AS name, {_CENTS} AS wage_rate_1, o_orderpriority AS wage_rate_2,
       '1996' AS year, NULL AS lca_case_number, NULL AS case_status, NULL AS lca_case_employer_name, NULL AS lca_case_wage_rate_from,
       NULL AS decision_date, NULL AS case_number, NULL AS employer_name, NULL AS wage_rate_of_pay_from, NULL AS worksite_city_1,
       NULL AS worksite_city_2, NULL AS city_2
FROM orders WHERE year(o_orderdate) <= 1996
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, '1998', {_KEY}, o_orderstatus, {_CUST}, {_CENTS}, {_DAY}, NULL, NULL, NULL, NULL, NULL, NULL
FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1998
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, '2001', NULL, o_orderstatus, NULL, NULL, {_DAY}, {_KEY}, {_CUST}, {_CENTS}, o_orderpriority,
       o_orderstatus, o_orderpriority
FROM orders WHERE year(o_orderdate) >= 1999
"""


# ---- H5/H6 on lineitem: repeated site groups and the dual-site layout

def q_drop_repeat_group_columns(spark, d):
    li = table(spark, d, "lineitem")
    v = li.select(
        F.col("l_orderkey").cast("string").alias("CASE_NUMBER"),
        F.col("l_linenumber").cast("string").alias("Worksite_City_1"),
        F.col("l_returnflag").alias("Worksite_City_2"), F.col("l_linestatus").alias("WORKSITE_CITY_3"),
        F.col("l_suppkey").cast("string").alias("worksite_state_1"), F.col("l_partkey").cast("string").alias("worksite_state_10"),
        F.col("l_returnflag").alias("City_2"), F.col("l_linestatus").alias("rate_per_2"),
        F.floor("l_quantity").cast("long").cast("string").alias("worksite_workers_x"))
    h = harmonize_vintage(v)
    return align_to_schema(h, ["case_number", "worksite_city", "worksite_state", "worksite_workers_x"])


SQL_DROP_REPEAT = """
SELECT CAST(l_orderkey AS VARCHAR) AS case_number, CAST(l_linenumber AS VARCHAR) AS worksite_city,
       CAST(l_suppkey AS VARCHAR) AS worksite_state, CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS worksite_workers_x
FROM lineitem
"""


# ---- H7 vs H8 on part, with permanent-program style headers

def part_vintage(spark, d):
    p = table(spark, d, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("CASE_NUMBER"),
        F.col("p_name").alias("EMP_BUSINESS_NAME"), F.col("p_brand").alias("Employer_Name"),
        F.col("p_type").alias("EMP_CITY"), F.col("p_size").cast("string").alias("JOB_OPP_PWD_NUMBER"),
        F.floor("p_retailprice").cast("long").cast("string").alias("pw_wage"),
        F.col("p_brand").alias("EMP_STATE"))


PERM_CANON = ["case_number", "employer_name", "employer_city", "employer_state_province", "pw_track_number",
              "pw_wage", "emp_business_name", "year", "form_type"]


def _perm_aligned(spark, d, policy):
    from recordlake.config.perm import ALIASES
    v = part_vintage(spark, d)
    slots = drop_blank_headers(drop_duplicate_headers(normalize_headers(slots_of(v.columns))))
    slots = alias_sequential_move(slots, ALIASES, policy=policy)
    h = select_slots(to_positional(v), slots)
    h = h.withColumn("year", F.lit("2024")).withColumn("form_type", F.lit("new"))
    return align_to_schema(h, PERM_CANON)


def q_alias_sequential_move(spark, d):
    return _perm_aligned(spark, d, "sequential_move")


def q_alias_first_wins(spark, d):
    return _perm_aligned(spark, d, "first_wins")


# literal policy: the self-alias of employer_name comes first in the map and
# deletes the original column; emp_business_name then moves onto it. The
# self-alias of pw_wage deletes that column for good.
SQL_SEQ_MOVE = """
SELECT CAST(p_partkey AS VARCHAR) AS case_number, p_name AS employer_name, p_type AS employer_city,
       p_brand AS employer_state_province, CAST(p_size AS VARCHAR) AS pw_track_number,
       CAST(NULL AS VARCHAR) AS pw_wage, CAST(NULL AS VARCHAR) AS emp_business_name,
       '2024' AS year, 'new' AS form_type
FROM part
"""
SQL_FIRST_WINS = """
SELECT CAST(p_partkey AS VARCHAR) AS case_number, p_name AS employer_name, p_type AS employer_city,
       p_brand AS employer_state_province, CAST(p_size AS VARCHAR) AS pw_track_number,
       CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS pw_wage, CAST(NULL AS VARCHAR) AS emp_business_name,
       '2024' AS year, 'new' AS form_type
FROM part
"""


# ---- H9/S8/S9 mapping-table rename: target schema = customer's columns

def _mapping_rows(spark, d):
    """Mapping rows as data, derived from the supplier table's own columns."""
    s = table(spark, d, "supplier")
    pairs = [("SUPP_KEY", "c_custkey"), ("SUPP_NAME", "c_name"), ("NATION", "c_nationkey"),
             ("ACCT_BAL", "c_acctbal"), ("S_PHONE", "s_phone_number")]
    return s, pairs


def pw_vintages(spark, d):
    s = table(spark, d, "supplier")
    a = s.where(F.col("s_suppkey") % 2 == 0).select(
        F.col("s_suppkey").alias("SUPP_KEY"), F.col("s_name").alias("SUPP_NAME"),
        F.col("s_nationkey").alias("NATION"), F.col("s_acctbal").alias("S_PHONE"),
        F.col("s_acctbal").alias("EXTRA_COL"), F.col("s_name").alias("S_COMMENT"))
    b = s.where(F.col("s_suppkey") % 2 == 1).select(
        F.col("s_suppkey").alias("SUPP_KEY"), F.col("s_name").alias("SUPP_NAME"),
        F.col("s_acctbal").alias("ACCT_BAL"), F.col("s_nationkey").alias("PW_TRACKING_NUMBER"), F.col("s_name").alias("S_COMMENT"))
    return [(2014, a), (2015, b)]


def _pw_plan(spark, d):
    from recordlake.config.pw import IGNORED_COLUMNS_BY_YEAR
    target = table(spark, d, "customer").schema  # S8: footer only
    _, pairs = _mapping_rows(spark, d)
    mapping = dict(pairs)
    frames, unmapped = [], {}
    for year, v in pw_vintages(spark, d):
        r = mapping_table_rename(v.columns, mapping, target.fieldNames(), IGNORED_COLUMNS_BY_YEAR.get(year, ()))
        if r.conflicts:
            raise ValueError(f"year {year}: several headers map to one target: {r.conflicts}")
        h = select_slots(to_positional(v), r.slots)
        frames.append(stamp_year(align_to_schema(h, target), year, "SOURCE_YEAR", cast="int"))
        unmapped[year] = (v, r.unmapped)
    return frames, unmapped


def q_mapping_table_rename(spark, d):
    frames, _ = _pw_plan(spark, d)
    return union_vintages(frames)


SQL_MAPPING = """
SELECT s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
       CAST(NULL AS VARCHAR) AS c_mktsegment, 2014 AS SOURCE_YEAR
FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL
SELECT s_suppkey, s_name, CAST(NULL AS INTEGER), s_acctbal, CAST(NULL AS VARCHAR), 2015
FROM supplier WHERE s_suppkey % 2 = 1
"""


def q_unmapped_column_report(spark, d):
    _, unmapped = _pw_plan(spark, d)
    return unmapped_values(unmapped)


SQL_UNMAPPED = """
SELECT name AS COLUMN_NAME, string_agg(year, ', ' ORDER BY year) AS YEARS_APPEARED, CAST(sum(n) AS BIGINT) AS N_VALUES
FROM (SELECT unnest(['EXTRA_COL', 'S_PHONE']) AS name, '2014' AS year, n FROM (
        SELECT count(s_acctbal) AS n FROM supplier WHERE s_suppkey % 2 = 0)
      UNION ALL
      SELECT 'S_COMMENT', y, n FROM (SELECT CASE WHEN s_suppkey % 2 = 0 THEN '2014' ELSE '2015' END AS y, count(s_name) AS n
                                     FROM supplier GROUP BY 1))
GROUP BY 1
"""


# ---- H13 with X7 on file names derived from part rows

def q_detect_form_type(spark, d):
    from recordlake.functions.urls import extract_year
    p = table(spark, d, "part")
    fname = F.concat(
        F.element_at(F.array(F.lit("PERM_Disclosure_Data_FY"), F.lit("PERM_old_form_FY"), F.lit("perm_"),
                             F.lit("Perm fy ")), (F.col("p_partkey") % 4 + 1).cast("int")),
        F.when(F.col("p_partkey") % 5 == 0, F.lit("")).otherwise((F.col("p_partkey") % 30 + 2000).cast("string")),
        F.lit(".xlsx"))
    f = p.select(F.col("p_partkey"), fname.alias("filename"))
    f = f.withColumn("year", extract_year(F.col("filename")))
    return f.select("p_partkey", "filename", "year", detect_form_type(F.col("filename"), F.col("year")).alias("form_type"))


SQL_FORM_TYPE = """
WITH f AS (
  SELECT p_partkey,
         (['PERM_Disclosure_Data_FY', 'PERM_old_form_FY', 'perm_', 'Perm fy '])[CAST(p_partkey % 4 + 1 AS INTEGER)]
         || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_partkey % 30 + 2000 AS VARCHAR) END || '.xlsx' AS filename
  FROM part),
y AS (
  SELECT *, regexp_extract(filename, '(?i)fy\\s*(\\d{2,4})', 1) AS fy, regexp_extract(filename, '(19|20)\\d{2}', 0) AS plain FROM f)
SELECT p_partkey, filename,
       CASE WHEN length(fy) = 2 THEN '20' || fy WHEN length(fy) > 2 THEN fy
            WHEN length(plain) > 0 THEN plain ELSE 'unknown_year' END AS year,
       CASE WHEN contains(lower(filename), 'old_form') THEN 'old'
            WHEN TRY_CAST(CASE WHEN length(fy) = 2 THEN '20' || fy WHEN length(fy) > 2 THEN fy
                               WHEN length(plain) > 0 THEN plain ELSE 'unknown_year' END AS INTEGER) <= 2023 THEN 'old'
            WHEN TRY_CAST(CASE WHEN length(fy) = 2 THEN '20' || fy WHEN length(fy) > 2 THEN fy
                               WHEN length(plain) > 0 THEN plain ELSE 'unknown_year' END AS INTEGER) IS NOT NULL THEN 'new'
       END AS form_type
FROM y
"""

QUERIES = {
    "harmonize_vintages": q_harmonize_vintages,
    "drop_all_null_columns": q_drop_all_null_columns,
    "drop_repeat_group_columns": q_drop_repeat_group_columns,
    "alias_sequential_move": q_alias_sequential_move,
    "alias_first_wins": q_alias_first_wins,
    "mapping_table_rename": q_mapping_table_rename,
    "unmapped_column_report": q_unmapped_column_report,
    "detect_form_type": q_detect_form_type,
}
ORACLE = {
    "harmonize_vintages": SQL_HARMONIZE,
    "drop_all_null_columns": SQL_DROP_ALL_NULL,
    "drop_repeat_group_columns": SQL_DROP_REPEAT,
    "alias_sequential_move": SQL_SEQ_MOVE,
    "alias_first_wins": SQL_FIRST_WINS,
    "mapping_table_rename": SQL_MAPPING,
    "unmapped_column_report": SQL_UNMAPPED,
    "detect_form_type": SQL_FORM_TYPE,
}
