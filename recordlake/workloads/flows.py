"""End-to-end checks (E1-E6): vintage files derived from ``orders``,
``customer`` and ``pages`` are written to the shared folder, then the plans run
on them exactly as they would on landed source files."""

from pyspark.sql import functions as F

from recordlake.config import codes
from recordlake.config import lca as lca_cfg
from recordlake.config.nulls import PANDAS_DEFAULT_NA_TOKENS
from recordlake.operators.manifest import save_manifest
from recordlake.plans import clean_lca, clean_perm, compile_lca, compile_perm, compile_pw, refresh
from recordlake.session import shared_dir, staging_path
from recordlake.sources.sinks import write_csv, write_parquet
from recordlake.workloads import _sql as S
from recordlake.workloads._tables import staged, table
from recordlake.workloads.discovery import SQL_CANDIDATES, listing_pages
from recordlake.workloads.standardise import STATUS_RAW, UNIT_RAW, VISA_RAW, YESNO_RAW

BATCH_ROWS = 2000
DATE_SHAPES = 6


# ------------------------------------------------------------------ flagship

def flagship(spark, d):
    """Records per standardised status and fiscal year over harmonised,
    de-duplicated vintages: E1 (S1 -> H1..H12 -> U1 -> U2 -> D2) -> E2 (C1..C11
    -> D3) -> P3 by (status, year)."""
    clean, _ = clean_lca(spark, compile_lca(spark, stage_lca(spark, d), batch_rows=BATCH_ROWS))
    return (clean.groupBy(F.col("Status").alias("status"), F.col("Fiscal Year").alias("fiscal_year"))
            .agg(F.count(F.lit(1)).alias("n_records")))


# ------------------------------------------------------------------ E1 / E2

def _pick(idx, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _key(k):
    return (F.when(k % 97 == 0, F.lit(None).cast("string"))
            .when(k % 3 == 0, F.concat(F.lit(" i-"), (k % 4000).cast("string"), F.lit(" ")))
            .otherwise(F.concat(F.lit("I-"), (k % 4000).cast("string"))))


def _date(k, ts, c):
    m = k % DATE_SHAPES
    return (F.when(m == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(m == 1, F.date_format(ts, "yyyy-MM-dd"))
            .when(m == 2, F.date_format(ts, "M/d/yyyy"))
            .when(m == 3, F.concat(F.lit(" "), F.date_format(ts, "MM/dd/yyyy"), F.lit(" ")))
            .when(m == 4, F.concat(F.lit("x"), F.date_format(ts, "yyyyMMdd"))).otherwise(c.cast("string")))


def _num(k, n):
    m = k % 6
    return (F.when(m == 0, n.cast("string")).when(m == 1, F.concat(F.lit("1,"), n.cast("string")))
            .when(m == 2, F.concat(F.lit(" "), n.cast("string"), F.lit(".25 ")))
            .when(m == 3, F.concat(F.lit("$"), n.cast("string"))).when(m == 4, F.concat(n.cast("string"), F.lit("e1")))
            .otherwise(F.lit("N/A")))


def _int_flag(k):
    m = k % 4
    return F.when(m == 0, F.lit("1")).when(m == 1, F.lit("0")).when(m == 2, F.lit("1.0")).otherwise(F.lit(None))


def lca_vintages(spark, d):
    o = table(spark, d, "orders")
    k, c, ts = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    y = F.year(ts)
    emp = F.concat(F.lit("Customer#"), c.cast("string"))
    v1 = o.where(y <= 1996).orderBy("o_orderkey").select(
        _key(k).alias("CASE_NO"), _pick(k % 10, STATUS_RAW).alias("APPROVAL_STATUS"),
        _pick(c % 10, VISA_RAW).alias("PROGRAM"), _date(k, ts, c).alias("SUBMITTED_DATE"), emp.alias("NAME"),
        F.col("o_orderpriority").alias("CITY_1"), _num(k, c).alias("WAGE_RATE_1"),
        _pick(k % 10, UNIT_RAW).alias("RATE_PER_1"), _num(k + 1, c).alias("WAGE_RATE_2"),
        F.col("o_orderstatus").alias("CITY_2"), _pick((k + c) % 10, YESNO_RAW).alias("FULL_TIME_POS"),
        F.lit("x").alias("Unnamed: 11"), F.lit(None).cast("string").alias("NA_COLUMN"))
    v2 = o.where((y >= 1997) & (y <= 1998)).orderBy("o_orderkey").select(
        _key(k).alias("LCA_CASE_NUMBER"), F.lit(None).cast("string").alias("STATUS"),
        _pick(k % 10, STATUS_RAW).alias("CASE_STATUS"), _pick(c % 10, VISA_RAW).alias("VISA_CLASS"),
        _date(k, ts, c).alias("LCA_CASE_SUBMIT"), _date(k + 1, ts, c).alias("DECISION_DATE"),
        emp.alias("LCA_CASE_EMPLOYER_NAME"), _num(k, c).alias("LCA_CASE_WAGE_RATE_FROM"),
        _pick(k % 10, UNIT_RAW).alias("LCA_CASE_WAGE_RATE_UNIT"), _pick((k + c) % 10, YESNO_RAW).alias("H-1B_Dependent"),
        _int_flag(k).alias("NEW_EMPLOYMENT"))
    v3 = o.where(y >= 1999).orderBy("o_orderkey").select(
        _key(k).alias("CASE_NUMBER"), _pick(k % 10, STATUS_RAW).alias("CASE_STATUS"),
        _pick(c % 10, VISA_RAW).alias("VISA_CLASS"), _date(k, ts, c).alias("RECEIVED_DATE"),
        _date(k + 2, ts, c).alias("DECISION_DATE"), emp.alias("EMPLOYER_NAME"),
        F.col("o_orderpriority").alias("WORKSITE_CITY_1"), F.col("o_orderstatus").alias("WORKSITE_CITY_2"),
        _num(k, c).alias("WAGE_RATE_OF_PAY_FROM_1"), _pick(k % 10, UNIT_RAW).alias("WAGE_UNIT_OF_PAY_1"),
        _num(k + 3, c).alias("PREVAILING_WAGE_1"), _pick((k + 5) % 10, UNIT_RAW).alias("PW_UNIT_OF_PAY_1"),
        _pick((k + c) % 10, YESNO_RAW).alias("FULL_TIME_POSITION"), _int_flag(k).alias("NEW_EMPLOYMENT"),
        _int_flag(k + 1).alias("CONTINUED_EMPLOYMENT"), (c % 10).cast("string").alias("TOTAL_WORKER_POSITIONS"),
        _pick((k + 7) % 10, YESNO_RAW).alias("WILLFUL_VIOLATOR"),
        F.concat(F.lit(" Level "), (k % 4 + 1).cast("string")).alias("PW_WAGE_LEVEL"))
    return v1, v2, v3


def stage_lca(spark, d):
    return staged(spark, d, "lca", lambda: _stage_lca(spark, d))


def _stage_lca(spark, d):
    root = staging_path(spark, "lca")
    v1, v2, v3 = lca_vintages(spark, d)
    write_csv(v1, f"{root}/1996/LCA_FY1996.csv")
    write_csv(v2, f"{root}/1998/LCA_FY1998.csv")
    write_parquet(v3, f"{root}/2001/LCA_Disclosure_Data_FY2001.parquet")
    write_csv(v3, f"{root}/2001/LCA_Worksites_FY2001.csv")
    return root


def q_compile_lca(spark, d):
    return compile_lca(spark, stage_lca(spark, d), batch_rows=BATCH_ROWS)


def _sql_pick(idx, values):
    return S.pick(idx, values)


def _sql_key(k="o_orderkey"):
    return (f"(CASE WHEN {k} % 97 = 0 THEN NULL WHEN {k} % 3 = 0 THEN ' i-' || ({k} % 4000) || ' ' "
            f"ELSE 'I-' || ({k} % 4000) END)")


def _sql_date(k):
    ts = "o_orderdate"
    return (f"(CASE ({k}) % {DATE_SHAPES} WHEN 0 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S') "
            f"WHEN 1 THEN strftime({ts}, '%Y-%m-%d') WHEN 2 THEN strftime({ts}, '%-m/%-d/%Y') "
            f"WHEN 3 THEN ' ' || strftime({ts}, '%m/%d/%Y') || ' ' WHEN 4 THEN 'x' || strftime({ts}, '%Y%m%d') "
            f"ELSE CAST(o_custkey AS VARCHAR) END)")


def _sql_num(k):
    n = "CAST(o_custkey AS VARCHAR)"
    return (f"(CASE ({k}) % 6 WHEN 0 THEN {n} WHEN 1 THEN '1,' || {n} WHEN 2 THEN ' ' || {n} || '.25 ' "
            f"WHEN 3 THEN '$' || {n} WHEN 4 THEN {n} || 'e1' ELSE 'N/A' END)")


def _sql_int_flag(k):
    return f"(CASE ({k}) % 4 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '1.0' END)"


def _canon_select(exprs: dict, year: str) -> str:
    out = []
    for c in lca_cfg.CANONICAL_COLUMNS:
        if c == "year":
            e = S.q(year)
        else:
            e = exprs.get(c, "NULL")
        if c == "case_number":
            e = f"COALESCE(upper(trim({e})), 'NONE')"
        e = f"CAST({e} AS VARCHAR)"
        out.append(f"CASE WHEN {e} IN ({', '.join(S.q(t) for t in PANDAS_DEFAULT_NA_TOKENS)}) THEN NULL ELSE {e} END AS {c}")
    return ", ".join(out)


def _sql_compile_lca():
    emp = "'Customer#' || o_custkey"
    v1 = {"case_number": _sql_key(), "case_status": _sql_pick("o_orderkey % 10", STATUS_RAW),
          "visa_class": _sql_pick("o_custkey % 10", VISA_RAW), "received_date": _sql_date("o_orderkey"),
          "employer_name": emp, "worksite_city": "o_orderpriority", "wage_rate_of_pay_from": _sql_num("o_orderkey"),
          "wage_unit_of_pay": _sql_pick("o_orderkey % 10", UNIT_RAW),
          "full_time_position": _sql_pick("(o_orderkey + o_custkey) % 10", YESNO_RAW)}
    v2 = {"case_number": _sql_key(), "case_status": _sql_pick("o_orderkey % 10", STATUS_RAW),
          "visa_class": _sql_pick("o_custkey % 10", VISA_RAW), "received_date": _sql_date("o_orderkey"),
          "decision_date": _sql_date("o_orderkey + 1"), "employer_name": emp,
          "wage_rate_of_pay_from": _sql_num("o_orderkey"), "wage_unit_of_pay": _sql_pick("o_orderkey % 10", UNIT_RAW),
          "h_1b_dependent": _sql_pick("(o_orderkey + o_custkey) % 10", YESNO_RAW),
          "new_employment": _sql_int_flag("o_orderkey")}
    v3 = {"case_number": _sql_key(), "case_status": _sql_pick("o_orderkey % 10", STATUS_RAW),
          "visa_class": _sql_pick("o_custkey % 10", VISA_RAW), "received_date": _sql_date("o_orderkey"),
          "decision_date": _sql_date("o_orderkey + 2"), "employer_name": emp, "worksite_city": "o_orderpriority",
          "wage_rate_of_pay_from": _sql_num("o_orderkey"), "wage_unit_of_pay": _sql_pick("o_orderkey % 10", UNIT_RAW),
          "prevailing_wage": _sql_num("o_orderkey + 3"), "pw_unit_of_pay": _sql_pick("(o_orderkey + 5) % 10", UNIT_RAW),
          "full_time_position": _sql_pick("(o_orderkey + o_custkey) % 10", YESNO_RAW),
          "new_employment": _sql_int_flag("o_orderkey"), "continued_employment": _sql_int_flag("o_orderkey + 1"),
          "total_worker_positions": "CAST(o_custkey % 10 AS VARCHAR)",
          "willful_violator": _sql_pick("(o_orderkey + 7) % 10", YESNO_RAW),
          "pw_wage_level": "' Level ' || (o_orderkey % 4 + 1)"}
    cols = ", ".join(lca_cfg.CANONICAL_COLUMNS)
    return f"""
    u AS (
      SELECT 1 AS v, o_orderkey, {_canon_select(v1, '1996')} FROM orders WHERE year(o_orderdate) <= 1996
      UNION ALL
      SELECT 2, o_orderkey, {_canon_select(v2, '1998')} FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1998
      UNION ALL
      SELECT 3, o_orderkey, {_canon_select(v3, '2001')} FROM orders WHERE year(o_orderdate) >= 1999),
    p AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY v, o_orderkey) - 1) / {BATCH_ROWS}) AS BIGINT) AS batch FROM u),
    compiled AS (SELECT {cols} FROM (
      SELECT *, min(batch) OVER (PARTITION BY case_number) AS mb FROM p) WHERE batch = mb)"""


SQL_COMPILE_LCA = f"WITH {_sql_compile_lca()} SELECT * FROM compiled"


def q_clean_lca(spark, d):
    clean, _ = clean_lca(spark, compile_lca(spark, stage_lca(spark, d), batch_rows=BATCH_ROWS))
    return clean


def _sql_ts(x):
    return (f"(CASE WHEN regexp_matches({x}, '^\\s*\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}( \\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}})?\\s*$') "
            f"THEN CAST(trim({x}) AS TIMESTAMP) "
            f"WHEN regexp_matches({x}, '^\\s*\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}\\s*$') THEN strptime(trim({x}), '%m/%d/%Y') END)")


_NUM_OK = "'^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$'"


def _sql_double(x):
    v = f"(CASE WHEN regexp_matches({x}, {_NUM_OK}) THEN TRY_CAST(trim({x}) AS DOUBLE) END)"
    return f"(CASE WHEN isinf({v}) OR isnan({v}) THEN NULL ELSE {v} END)"


def _sql_long(x):
    v = _sql_double(x)
    return f"(CASE WHEN {v} = floor({v}) AND abs({v}) < 9.223372036854775807e18 THEN CAST({v} AS BIGINT) END)"


def _sql_text(x):
    t = S.strip(x)
    return f"(CASE WHEN {t} IN ('nan', 'NAN', '') THEN NULL ELSE {t} END)"


def _sql_clean_lca():
    m = lca_cfg.DISPLAY_COLUMNS
    sel = []
    for src, disp in m.items():
        x = src
        if disp == "Status":
            e = S.recode(f"upper({S.strip(x)})", codes.STATUS_MAP_LCA, codes.STATUS_NULLS)
        elif disp == "Visa Class":
            e = S.recode(S.strip(x), codes.VISA_CLASS_MAP, codes.VISA_CLASS_NULLS)
        elif disp in lca_cfg.DATE_COLUMNS:
            e = _sql_ts(x)
        elif disp in lca_cfg.NUMBER_COLUMNS:
            e = _sql_double(x)
        elif disp in lca_cfg.PAY_UNIT_COLUMNS:
            e = S.recode(S.strip(x), codes.PAY_UNIT_MAP, codes.PAY_UNIT_NULLS)
        elif disp in lca_cfg.YES_NO_COLUMNS:
            e = S.recode(S.strip(x), codes.YES_NO_MAP, codes.YES_NO_NULLS)
        elif disp in lca_cfg.INTEGER_COLUMNS:
            e = _sql_long(x)
        elif disp in lca_cfg.TEXT_COLUMNS:
            e = _sql_text(x)
        else:
            e = x
        sel.append(f'{e} AS "{disp}"')
    return f"clean AS (SELECT DISTINCT {', '.join(sel)} FROM compiled)"


SQL_CLEAN_LCA = f"WITH {_sql_compile_lca()}, {_sql_clean_lca()} SELECT * FROM clean"


# ------------------------------------------------------------------ E3 / E4

PERM_SCHEMA = ["case_number", "case_status", "decision_date", "employer_name", "employer_city",
               "employer_state_province", "class_of_admission", "pw_track_number", "year", "form_type"]


def _perm_key(k):
    m = k % 5
    base = (k % 3000).cast("string")
    return (F.when(m == 0, F.concat(F.lit("a-"), base)).when(m == 1, F.concat(F.lit("A-"), base))
            .when(m == 2, F.concat(F.lit(" A-"), base)).when(m == 3, F.concat(F.lit("A-"), base))
            .otherwise(F.lit(None).cast("string")))


def perm_vintages(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    ts = F.col("o_orderdate")
    y = F.year(ts)
    status = _pick(k % 10, STATUS_RAW)
    emp = F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string"))
    v_old = o.where(y <= 1996).orderBy(k).select(
        _perm_key(k).alias("CASE_NUMBER"), status.alias("CASE_STATUS"), F.date_format(ts, "yyyy-MM-dd").alias("DECISION_DATE"),
        emp.alias("EMPLOYER_NAME"), F.col("o_orderstatus").alias("EMPLOYER_CITY"),
        F.col("o_orderpriority").alias("EMPLOYER_STATE_PROVINCE"),
        F.concat(F.lit(" h-"), (k % 3).cast("string")).alias("CLASS_OF_ADMISSION"))
    v_oldform = o.where((y >= 1997) & (y <= 1998)).orderBy(k).select(
        _perm_key(k).alias("CASE_NUMBER"), status.alias("CASE_STATUS"),
        F.date_format(ts, "M/d/yyyy").alias("DECISION_DATE"),
        F.col("o_orderstatus").alias("EMP_CITY"), F.lit("nan").alias("CLASS_OF_ADMISSION"))
    v_new = o.where(y >= 1999).orderBy(k).select(
        _perm_key(k).alias("case_number"), status.alias("case_status"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("decision_date"), emp.alias("emp_business_name"),
        F.col("o_orderstatus").alias("emp_city"), F.col("o_orderpriority").alias("emp_state"),
        (k % 1000).cast("string").alias("job_opp_pwd_number"), F.lit("h-1b").alias("class_of_admission"))
    return v_old, v_oldform, v_new


def stage_perm(spark, d):
    return staged(spark, d, "perm", lambda: _stage_perm(spark, d))


def _stage_perm(spark, d):
    root = staging_path(spark, "perm")
    a, b, c = perm_vintages(spark, d)
    write_parquet(a, f"{root}/2019/PERM_Disclosure_Data_FY2019.parquet")
    write_parquet(b, f"{root}/2024/PERM_Disclosure_Data_FY2024_old_form.parquet")
    write_parquet(c, f"{root}/2024/PERM_Disclosure_Data_FY2024_new_form.parquet")
    return root


def q_compile_perm(spark, d):
    return compile_perm(spark, stage_perm(spark, d), PERM_SCHEMA)


def _sql_perm_key(k):
    b = f"CAST({k} % 3000 AS VARCHAR)"
    return (f"(CASE {k} % 5 WHEN 0 THEN 'a-' || {b} WHEN 1 THEN 'A-' || {b} WHEN 2 THEN ' A-' || {b} "
            f"WHEN 3 THEN 'A-' || {b} END)")


def _sql_compile_perm():
    k = "o_orderkey"
    st = S.pick(f"{k} % 10", STATUS_RAW)
    return f"""
    u AS (
      SELECT 1 AS v, {k} AS k, {_sql_perm_key(k)} AS case_number, {st} AS case_status,
             strftime(o_orderdate, '%Y-%m-%d') AS decision_date, CAST(NULL AS VARCHAR) AS employer_name,
             CAST(NULL AS VARCHAR) AS employer_city, CAST(NULL AS VARCHAR) AS employer_state_province,
             ' h-' || ({k} % 3) AS class_of_admission, CAST(NULL AS VARCHAR) AS pw_track_number,
             '2019' AS year, 'old' AS form_type
      FROM orders WHERE year(o_orderdate) <= 1996
      UNION ALL
      SELECT 3, {k}, {_sql_perm_key(k)}, {st}, strftime(o_orderdate, '%-m/%-d/%Y'), NULL, o_orderstatus, NULL, 'nan',
             NULL, '2024', 'old'
      FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1998
      UNION ALL
      SELECT 2, {k}, {_sql_perm_key(k)}, {st}, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 'Customer#' || o_custkey,
             o_orderstatus, o_orderpriority, 'h-1b', CAST({k} % 1000 AS VARCHAR), '2024', 'new'
      FROM orders WHERE year(o_orderdate) >= 1999),
    n AS (SELECT *, COALESCE(upper(case_number), 'NONE') AS ck FROM u),
    compiled AS (
      SELECT ck AS case_number, case_status, decision_date, employer_name, employer_city, employer_state_province,
             class_of_admission, pw_track_number, year, form_type
      FROM (SELECT *, row_number() OVER (PARTITION BY ck ORDER BY v, k) AS rn FROM n) WHERE rn = 1)"""


SQL_COMPILE_PERM = f"WITH {_sql_compile_perm()} SELECT * FROM compiled"


def q_clean_perm(spark, d):
    clean, _ = clean_perm(spark, compile_perm(spark, stage_perm(spark, d), PERM_SCHEMA))
    return clean


def _tok(x):
    return f"(CASE WHEN {x} IN ({', '.join(S.q(t) for t in PANDAS_DEFAULT_NA_TOKENS)}) THEN NULL ELSE {x} END)"


def _upper_text(x):
    t = f"upper({S.strip(x)})"
    return f"(CASE WHEN {t} IN ('NAN', '') THEN NULL ELSE {t} END)"


SQL_CLEAN_PERM = f"""
WITH {_sql_compile_perm()},
t AS (SELECT {_tok('case_number')} AS case_number, {_tok('case_status')} AS case_status,
             {_tok('decision_date')} AS decision_date, {_tok('year')} AS year, {_tok('form_type')} AS form_type,
             {_tok('class_of_admission')} AS class_of_admission FROM compiled)
SELECT DISTINCT case_number AS "Case Number",
       {S.recode(f"upper({S.strip('case_status')})", codes.STATUS_MAP_PERM, codes.STATUS_NULLS)} AS "Status",
       {_sql_ts('decision_date')} AS "Decision Date", year AS "Fiscal Year",
       {_upper_text('form_type')} AS "Form Type", {_upper_text('class_of_admission')} AS "Current Visa Type"
FROM t
"""


# ------------------------------------------------------------------ E5

PW_MAPPING = [("CASE_NO", "CASE_NUMBER"), ("STATUS", "CASE_STATUS"), ("BUSINESS_NAME", "EMPLOYER_LEGAL_BUSINESS_NAME"),
              ("EIN", "EMPLOYER_FEIN"), (" ACCT ", " PWD_WAGE_RATE "), ("SEGMENT", "MARKET"),
              ("CASE_NUMBER", "CASE_NUMBER"), ("CASE_STATUS", "CASE_STATUS"),
              ("EMPLOYER_LEGAL_BUSINESS_NAME", "EMPLOYER_LEGAL_BUSINESS_NAME"), ("EMPLOYER_FEIN", "EMPLOYER_FEIN"),
              ("PWD_WAGE_RATE", "PWD_WAGE_RATE"), ("STATUS", "CASE_STATUS")]


def stage_pw(spark, d):
    return staged(spark, d, "pw", lambda: _stage_pw(spark, d))


def _stage_pw(spark, d):
    root = staging_path(spark, "pw")
    c = table(spark, d, "customer")
    key = F.concat(F.lit("P-"), F.col("c_custkey").cast("string"))
    fein = F.lpad((F.col("c_custkey") * 7919 % 1000000).cast("string"), 9, "0")
    wage = F.format_string("%.2f", F.col("c_acctbal"))
    t2025 = c.where(F.col("c_custkey") % 4 == 0).select(
        key.alias("CASE_NUMBER"), F.col("c_mktsegment").alias("CASE_STATUS"),
        F.col("c_name").alias("EMPLOYER_LEGAL_BUSINESS_NAME"), fein.alias("EMPLOYER_FEIN"), wage.alias("PWD_WAGE_RATE"))
    t2015 = c.where(F.col("c_custkey") % 4 == 1).select(
        key.alias("CASE_NO"), F.col("c_mktsegment").alias("STATUS"), F.col("c_name").alias("BUSINESS_NAME"),
        fein.alias("EIN"), wage.alias("ACCT"), F.lit("t").alias("PW_TRACKING_NUMBER"),
        F.col("c_nationkey").cast("string").alias("NATION"))
    t2019 = c.where(F.col("c_custkey") % 4 >= 2).select(
        key.alias("CASE_NUMBER"), F.col("c_mktsegment").alias("CASE_STATUS"), F.col("c_name").alias("BUSINESS_NAME"),
        F.col("c_mktsegment").alias("SEGMENT"), F.col("c_nationkey").cast("string").alias("PW_TRACKING_NUMBER"))
    write_parquet(t2025, f"{root}/2025/PW_Disclosure_Data_FY2025.parquet")
    write_parquet(t2015, f"{root}/2015/PW_FY2015.parquet")
    write_parquet(t2019, f"{root}/2019/PW_Disclosure_Data_FY2019_new_form.parquet")
    write_parquet(t2019, f"{root}/2019/PW_Disclosure_Data_FY2019.parquet")
    write_parquet(t2025, f"{root}/misc/notes.parquet")
    mapping = spark.createDataFrame(PW_MAPPING, "ORIGINAL string, FINAL_2025 string")
    write_csv(mapping.coalesce(1), f"{root}/mapping.csv")
    return root


def q_compile_pw(spark, d):
    root = stage_pw(spark, d)
    result, _ = compile_pw(spark, root, f"{root}/mapping.csv")
    return result


_PW_KEY = "'P-' || c_custkey"
_PW_FEIN = "lpad(CAST(c_custkey * 7919 % 1000000 AS VARCHAR), 9, '0')"
_PW_WAGE = "printf('%.2f', c_acctbal)"
SQL_COMPILE_PW = f"""
SELECT {_PW_KEY} AS CASE_NUMBER, c_mktsegment AS CASE_STATUS, c_name AS EMPLOYER_LEGAL_BUSINESS_NAME,
       {_PW_FEIN} AS EMPLOYER_FEIN, {_PW_WAGE} AS PWD_WAGE_RATE, 2025 AS SOURCE_YEAR FROM customer WHERE c_custkey % 4 = 0
UNION ALL
SELECT {_PW_KEY}, c_mktsegment, c_name, {_PW_FEIN}, {_PW_WAGE}, 2015 FROM customer WHERE c_custkey % 4 = 1
UNION ALL
SELECT {_PW_KEY}, c_mktsegment, c_name, NULL, NULL, 2019 FROM customer WHERE c_custkey % 4 >= 2
"""


def q_compile_pw_report(spark, d):
    root = stage_pw(spark, d)
    _, report = compile_pw(spark, root, f"{root}/mapping.csv")
    return report


SQL_PW_REPORT = """
SELECT unnest(['NATION']) AS COLUMN_NAME, '2015' AS YEARS_APPEARED, count(c_nationkey) AS N_VALUES FROM customer WHERE c_custkey % 4 = 1
UNION ALL
SELECT 'PW_TRACKING_NUMBER', '2019', count(c_nationkey) FROM customer WHERE c_custkey % 4 >= 2
UNION ALL
SELECT 'SEGMENT', '2019', count(c_mktsegment) FROM customer WHERE c_custkey % 4 >= 2
"""


# ------------------------------------------------------------------ E6

def _observations(spark, cands):
    u = F.col("url")
    return cands.select(
        "url", (F.length(u) % 13 != 0).alias("fetch_ok"),
        F.concat(F.lit("e"), (F.length(u) % 3).cast("string")).alias("etag"),
        F.concat(F.lit("lm"), (F.length(u) % 5).cast("string")).alias("last_modified"),
        F.sha2(u, 256).alias("sha256"))


def q_refresh(spark, d):
    from recordlake.operators.discover import discover_candidates
    from recordlake.operators.manifest import MANIFEST_V1_SCHEMA
    lp = listing_pages(spark, d)
    # fixture setup (the previous manifest and what fetching returned) is
    # derived from one discovery run, materialised once
    shared_dir(spark)
    cands = discover_candidates(lp).checkpoint(eager=True)
    root = staging_path(spark, "refresh")
    u = F.col("url")
    prev = cands.where(F.length(u) % 4 != 0).select(
        "url", "program", "year", "filename", F.lit("old").alias("saved_path"),
        F.when(F.length(u) % 4 == 1, F.sha2(u, 256)).otherwise(F.lit("x")).alias("sha256"),
        F.when(F.length(u) % 4 == 2, F.concat(F.lit("e"), (F.length(u) % 3).cast("string"))).otherwise(F.lit("")).alias("etag"),
        F.concat(F.lit("lm"), (F.length(u) % 7).cast("string")).alias("last_modified"),
        F.lit("2025-01-01").alias("downloaded_at"), F.lit(None).cast("string").alias("checked_at"))
    save_manifest(prev.select(*MANIFEST_V1_SCHEMA.fieldNames()), root, 1)
    out = refresh(spark, lp, _observations(spark, cands), root, run_time="2026-01-01T00:00:00+00:00")
    return out["statuses"].select("url", "program", "year", "status", "is_new")


SQL_REFRESH = f"""
WITH cands AS ({SQL_CANDIDATES}),
m AS (SELECT url, CASE WHEN length(url) % 4 = 1 THEN sha256(url) ELSE 'x' END AS sha256,
             CASE WHEN length(url) % 4 = 2 THEN 'e' || (length(url) % 3) ELSE '' END AS etag,
             'lm' || (length(url) % 7) AS last_modified FROM cands WHERE length(url) % 4 <> 0),
o AS (SELECT url, program, year, length(url) % 13 <> 0 AS fetch_ok, 'e' || (length(url) % 3) AS etag,
             'lm' || (length(url) % 5) AS last_modified, sha256(url) AS sha256 FROM cands)
SELECT o.url, o.program, o.year,
  CASE WHEN m.url IS NOT NULL AND o.etag <> '' AND o.etag = m.etag THEN 'skipped_etag'
       WHEN m.url IS NOT NULL AND o.last_modified <> '' AND o.last_modified = m.last_modified THEN 'skipped_lastmod'
       WHEN NOT o.fetch_ok THEN 'failed'
       WHEN m.url IS NOT NULL AND o.sha256 = m.sha256 THEN 'skipped_hash'
       ELSE 'downloaded' END AS status,
  CASE WHEN m.url IS NOT NULL AND o.etag <> '' AND o.etag = m.etag THEN false
       WHEN m.url IS NOT NULL AND o.last_modified <> '' AND o.last_modified = m.last_modified THEN false
       WHEN NOT o.fetch_ok THEN false
       WHEN m.url IS NOT NULL AND o.sha256 = m.sha256 THEN false
       ELSE true END AS is_new
FROM o LEFT JOIN m ON o.url = m.url
"""

QUERIES = {
    "flagship_status_by_year": flagship,
    "compile_lca": q_compile_lca,
    "clean_lca": q_clean_lca,
    "compile_perm": q_compile_perm,
    "clean_perm": q_clean_perm,
    "compile_pw": q_compile_pw,
    "compile_pw_unmapped_report": q_compile_pw_report,
    "refresh": q_refresh,
}
SQL_FLAGSHIP = f"""WITH {_sql_compile_lca()}, {_sql_clean_lca()}
SELECT "Status" AS status, "Fiscal Year" AS fiscal_year, count(*) AS n_records FROM clean GROUP BY 1, 2"""

ORACLE = {
    "flagship_status_by_year": SQL_FLAGSHIP,
    "compile_lca": SQL_COMPILE_LCA,
    "clean_lca": SQL_CLEAN_LCA,
    "compile_perm": SQL_COMPILE_PERM,
    "clean_perm": SQL_CLEAN_PERM,
    "compile_pw": SQL_COMPILE_PW,
    "compile_pw_unmapped_report": SQL_PW_REPORT,
    "refresh": SQL_REFRESH,
}
