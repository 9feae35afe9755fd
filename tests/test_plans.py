"""E1-E6 on the FIXTURES.md shapes, written as small files."""

import os
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from recordlake.plans import clean_lca, clean_perm, compile_lca, compile_perm, compile_pw, refresh


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_compile_and_clean_lca(spark, tmp_root):
    write(f"{tmp_root}/2009/H1B_FY2009.csv",
          "CASE_NO,APPROVAL_STATUS,NAME,CITY_1,CITY_2,WAGE_RATE_1,RATE_PER_1,Unnamed: 7\n"
          " i-1 ,certified,Acme,Boston,NYC,50000,yr,\ni-2,DENIED,NULL,Austin,,\"1,000\",hr,\n")
    write(f"{tmp_root}/2009/H1B_FY2009_Appendix.csv", "CASE_NO\nI-9\n")
    write(f"{tmp_root}/2019/LCA_FY2019.csv",
          "CASE_NUMBER,STATUS,CASE_STATUS,WORKSITE_CITY_1,WORKSITE_CITY_2,NEW_EMPLOYMENT,DECISION_DATE\n"
          "I-1,,CERTIFIED-WITHDRAWN,Denver,Reno,1,2019-10-01\ni-3,,Withdrawn,Miami,,0,10/1/2019\n"
          ",,Denied,Tulsa,,1.0,garbage\n")
    out = compile_lca(spark, tmp_root, batch_rows=2)
    assert len(out.columns) == 107
    rows = {r["case_number"]: r for r in out.collect()}
    # I-1 appears in batch 0 (2009) so its 2019 row is dropped; null key -> NONE
    assert set(rows) == {"I-1", "I-2", "I-3", "NONE"}
    assert rows["I-1"]["worksite_city"] == "Boston" and rows["I-1"]["year"] == "2009"
    assert rows["I-2"]["employer_name"] is None  # "NULL" token after the CSV hop
    assert rows["I-3"]["case_status"] == "Withdrawn" and rows["I-3"]["worksite_city"] == "Miami"
    clean, prof = clean_lca(spark, out)
    c = {r["Case Number"]: r for r in clean.collect()}
    assert c["I-1"]["Status"] == "Certified" and c["I-1"]["Wage From"] == 50000.0 and c["I-1"]["Wage Unit"] == "Year"
    assert c["I-2"]["Wage From"] is None and c["I-3"]["Decision Date"].year == 2019
    assert c["I-3"]["New Employment"] == 0 and c["NONE"]["New Employment"] == 1
    assert prof["counts"].first()["rows_after"] == 4
    assert {r["value"] for r in prof["Status"].collect()} == {"Certified", "Denied", "Withdrawn"}


def test_compile_perm_literal_and_intended(spark, tmp_root):
    write(f"{tmp_root}/2023/PERM_FY2023.csv",
          "CASE_NUMBER,CASE_STATUS,EMPLOYER_NAME,EMPLOYER_CITY,PW_WAGE\na-1,Certified,Acme,Boston,100\n")
    write(f"{tmp_root}/2024/PERM_FY2024.csv",
          "case_number,case_status,emp_business_name,emp_city,job_opp_pwd_number\nA-1,Denied,Beta,Austin,P-9\n"
          "A-2,Denied,Gamma,Reno,P-8\n")
    write(f"{tmp_root}/2024/PERM_FY2024_old_form.csv", "EMPLOYER_NAME\nDelta\n")
    schema = ["case_number", "case_status", "employer_name", "employer_city", "pw_wage", "pw_track_number",
              "year", "form_type"]
    lit = {r["case_number"]: r for r in compile_perm(spark, tmp_root, schema).collect()}
    # a-1 and A-1 collapse after upper-casing: the 2023 row is first
    assert lit["A-1"]["year"] == "2023" and lit["A-1"]["form_type"] == "old"
    assert lit["A-1"]["employer_name"] is None and lit["A-1"]["pw_wage"] is None   # T1 self-aliases
    assert lit["A-2"]["employer_name"] == "Gamma" and lit["A-2"]["pw_track_number"] == "P-8"
    assert lit["A-2"]["form_type"] == "new"
    assert lit["NONE"]["form_type"] == "old"  # file without case numbers collapses to one row (T3)
    fw = {r["case_number"]: r for r in compile_perm(spark, tmp_root, schema, alias_policy="first_wins").collect()}
    assert fw["A-1"]["employer_name"] == "Acme" and fw["A-1"]["pw_wage"] == "100"
    derived = compile_perm(spark, tmp_root)
    assert derived.columns == ["case_number", "case_status", "employer_name", "employer_city",
                               "pw_track_number", "year", "form_type"]
    assert derived.count() == 3
    clean, prof = clean_perm(spark, compile_perm(spark, tmp_root, schema))
    assert clean.columns == ["Case Number", "Status", "Fiscal Year", "Form Type"]
    assert {r["Form Type"] for r in clean.collect()} == {"OLD", "NEW"}


def test_compile_pw(spark, tmp_root):
    def pq(path, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(path)
    pq(f"{tmp_root}/2025/PW_Disclosure_Data_FY2025.parquet", [("C-1", "Certified", "12")],
       "CASE_NUMBER string, CASE_STATUS string, EMPLOYER_FEIN string")
    pq(f"{tmp_root}/2015/PW_FY2015.parquet", [("C-2", "Denied", "34", "t")],
       "CASE_NO string, STATUS string, EIN string, VOIDED_DATE string")
    pq(f"{tmp_root}/2016/PW_FY2016.parquet", [("C-3", "x")], "CASE_NO string, ODD string")
    write(f"{tmp_root}/map.csv", "ORIGINAL,FINAL_2025\nCASE_NO,CASE_NUMBER\nSTATUS,CASE_STATUS\nEIN,EMPLOYER_FEIN\n"
          "CASE_NUMBER,CASE_NUMBER\nCASE_STATUS,CASE_STATUS\nEMPLOYER_FEIN,EMPLOYER_FEIN\nODD,NOPE\n")
    out, report = compile_pw(spark, tmp_root, f"{tmp_root}/map.csv")
    assert out.columns == ["CASE_NUMBER", "CASE_STATUS", "EMPLOYER_FEIN", "SOURCE_YEAR"]
    assert sorted(tuple(r) for r in out.collect()) == [("C-1", "Certified", "12", 2025), ("C-2", "Denied", "34", 2015),
                                                       ("C-3", None, None, 2016)]
    assert [tuple(r) for r in report.collect()] == [("ODD", "2016", 1)]


def test_compile_pw_conflict(spark, tmp_root):
    spark.createDataFrame([("1", "2")], "EMPLOYER_FEIN string, X string").write.parquet(
        f"{tmp_root}/2025/PW_Disclosure_Data_FY2025.parquet")
    spark.createDataFrame([("1", "2")], "EIN string, EMPLOYER_FEIN string").write.parquet(f"{tmp_root}/2020/a.parquet")
    write(f"{tmp_root}/map.csv", "ORIGINAL,FINAL_2025\nEIN,EMPLOYER_FEIN\nEMPLOYER_FEIN,EMPLOYER_FEIN\n")
    with pytest.raises(RuntimeError, match="2020"):
        compile_pw(spark, tmp_root, f"{tmp_root}/map.csv")
    out, _ = compile_pw(spark, tmp_root, f"{tmp_root}/map.csv", on_conflict="first")
    assert out.where(F.col("SOURCE_YEAR") == 2020).first()["EMPLOYER_FEIN"] == "1"


def test_refresh_end_to_end(spark, tmp_root):
    html = ('<table><tr><td>LCA</td><td><a href="/f/a_FY2024.xlsx">a</a></td></tr></table>'
            '<h2>PERM Program</h2><p><a href="/f/b_2023.csv">b</a></p>')
    pages = spark.createDataFrame([(1, "https://x.gov/perf", html)], "page_id long, url string, html string")
    obs = spark.createDataFrame([("https://x.gov/f/a_FY2024.xlsx", True, "e1", "l1", "h1"),
                                 ("https://x.gov/f/b_2023.csv", True, "e2", "l2", "h2")],
                                "url string, fetch_ok boolean, etag string, last_modified string, sha256 string")
    root = f"{tmp_root}/manifest"
    first = refresh(spark, pages, obs, root, run_time="t1")
    assert {r["status"] for r in first["statuses"].collect()} == {"downloaded"}
    s = first["summary"].first()
    assert (s["lca"], s["perm"], s["pw"], s["files_downloaded"]) == (True, True, False, 2)
    second = refresh(spark, pages, obs, root, run_time="t2")
    assert {r["status"] for r in second["statuses"].collect()} == {"skipped_etag"}
    assert second["manifest_version"] == 2


def test_grouped_vintages_share_one_scan(spark, tmp_root):
    root = f"{tmp_root}/LCA Program"
    # two quarterly files with the same headers: in Q1 the first status column is
    # empty (so the second wins), in Q2 it is filled (so it wins)
    write(f"{root}/2020/LCA_FY2020_Q1.csv", "CASE_NO,STATUS,CASE_STATUS\nq1-a,,Certified\nq1-b,,Denied\n")
    write(f"{root}/2020/LCA_FY2020_Q2.csv", "CASE_NO,STATUS,CASE_STATUS\nq2-a,Withdrawn,Certified\nq1-a,Denied,x\n")
    write(f"{root}/2021/LCA FY2021.csv", "CASE_NUMBER,CASE_STATUS\nq1-b,Certified\nz,Denied\n")
    out = compile_lca(spark, root, batch_rows=2)
    got = {r["case_number"]: (r["case_status"], r["year"]) for r in out.collect()}
    # batches (2 rows each, load order Q1, Q2, 2021): [q1-a q1-b] [q2-a q1-a] [q1-b z]
    assert got == {"Q1-A": ("Certified", "2020"), "Q1-B": ("Denied", "2020"), "Q2-A": ("Withdrawn", "2020"),
                   "Z": ("Denied", "2021")}


def test_corrupt_vintage_fails_unless_ignored(spark, tmp_root):
    write(f"{tmp_root}/2020/LCA_FY2020.csv", "CASE_NUMBER,CASE_STATUS\na,Certified\n")
    spark.createDataFrame([("b", "Denied")], "CASE_NUMBER string, CASE_STATUS string").write.parquet(
        f"{tmp_root}/2021/LCA_FY2021.parquet")
    import glob
    part = sorted(glob.glob(f"{tmp_root}/2021/LCA_FY2021.parquet/part-*.parquet"))[0]
    with open(part, "r+b") as f:  # keep the footer, break the data pages
        f.seek(4)
        f.write(b"\x00" * 64)
    with pytest.raises(Exception):
        compile_lca(spark, tmp_root).count()
    out = compile_lca(spark, tmp_root, ignore_corrupt=True)
    assert "A" in {r["case_number"] for r in out.collect()}


def test_compile_without_listing_broadcast(spark, tmp_root, monkeypatch):
    monkeypatch.setitem(SETTINGS, "spark.sql.autoBroadcastJoinThreshold", "-1")  # a plain join on the file
    with settings(spark):
        compile_quarters(spark, tmp_root)


SETTINGS: dict = {}


@contextmanager
def settings(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def compile_quarters(spark, tmp_root):
    write(f"{tmp_root}/2020/LCA_FY2020_Q1.csv", "CASE_NO,STATUS\na,Certified\nb,Denied\n")
    write(f"{tmp_root}/2020/LCA_FY2020_Q2.csv", "CASE_NO,STATUS\na,Withdrawn\nc,Denied\n")
    got = sorted((r["case_number"], r["case_status"]) for r in compile_lca(spark, tmp_root, batch_rows=10).collect())
    # one batch holds all four rows, so both rows of A survive (duplicates inside the first batch stay)
    assert got == [("A", "Certified"), ("A", "Withdrawn"), ("B", "Denied"), ("C", "Denied")]


def test_first_batches_survive_another_split_of_the_files(spark, tmp_root):
    for y in range(2009, 2021):
        write(f"{tmp_root}/{y}/LCA_FY{y}.csv",
              "CASE_NUMBER,STATUS\n" + "".join(f"I-{(y * 37 + i) % 400},s{i}\n" for i in range(120)))
    keys = ["spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k, None) for k in keys}
    out = compile_lca(spark, tmp_root, batch_rows=50)
    try:
        n = out.count()
        for values in (("1", "1", "1g"), ("100m", "24", "64")):
            for k, v in zip(keys, values):
                spark.conf.set(k, v)
            again = out.where(F.lit(True)).select("*")
            assert again.count() == n
            assert compile_lca(spark, tmp_root, batch_rows=50).count() == n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_header_with_a_line_break_keeps_every_column(spark, tmp_root):
    write(f"{tmp_root}/2020/LCA_FY2020.csv", '"CASE_NUMBER","CASE\nSTATUS",EMPLOYER_NAME\nI-1,x,Acme\nI-2,y,Beta\n')
    rows = {r["case_number"]: r["employer_name"] for r in compile_lca(spark, tmp_root).collect()}
    assert rows == {"I-1": "Acme", "I-2": "Beta"}


def test_a_damaged_parquet_file_gives_way_to_its_csv_sibling(spark, tmp_root):
    import glob
    write(f"{tmp_root}/2020/LCA_FY2020.csv", "CASE_NUMBER,STATUS\na,Certified\nb,Denied\n")
    rows = spark.createDataFrame([("a", "Certified"), ("b", "Denied")], "CASE_NUMBER string, STATUS string").coalesce(1)
    rows.write.parquet(f"{tmp_root}/2020/LCA_FY2020.parquet")
    part = sorted(glob.glob(f"{tmp_root}/2020/LCA_FY2020.parquet/part-*.parquet"))[0]
    os.unlink(os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc"))
    with open(part, "r+b") as f:  # the footer stays
        f.seek(4)
        f.write(b"\x00" * 64)
    with pytest.warns(UserWarning, match="0 of 2 rows can be read"):
        out = compile_lca(spark, tmp_root, check_rows=True)
    assert sorted(r["case_number"] for r in out.collect()) == ["A", "B"]
    with open(part, "r+b") as f:  # now the footer is gone too: seen without reading rows
        f.truncate(100)
    with pytest.warns(UserWarning, match="skipping unreadable file"):
        assert compile_lca(spark, tmp_root).count() == 2
    write(f"{tmp_root}/2021/LCA_FY2021.parquet", "no parquet")
    with pytest.raises(OSError, match="no readable file"), pytest.warns(UserWarning):
        compile_lca(spark, tmp_root)


def jobs(spark, run):
    group = f"jobs-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_files(spark, tmp_root):
    from recordlake.plans._common import main_files
    from recordlake.sources.files import land_text_parquet, vintage_scan

    def files(root, years):
        for y in years:
            write(f"{root}/{y}/LCA_FY{y}.csv", f"CASE_NUMBER,STATUS\nI-{y},Certified\n")
    files(f"{tmp_root}/few", range(2015, 2018))
    files(f"{tmp_root}/many", range(2000, 2020))
    for f in (lambda r: compile_lca(spark, r), lambda r: land_text_parquet(spark, vintage_scan(spark, r))):
        few, many = [jobs(spark, lambda r=r: f(r)) for r in (f"{tmp_root}/few", f"{tmp_root}/many")]
        assert few == many > 0
    assert len(main_files(spark, f"{tmp_root}/many", land=False)) == 20
    got = sorted(r["case_number"] for r in compile_lca(spark, f"{tmp_root}/many").collect())
    assert got == [f"I-{y}" for y in range(2000, 2020)]


def test_files_of_one_header_with_different_empty_columns_are_one_scan(spark, tmp_root):
    for y, rows in ((2018, "a,,x\n"), (2019, "b,y,\n"), (2020, "c,z,w\n")):
        write(f"{tmp_root}/{y}/LCA_FY{y}.csv", "CASE_NUMBER,STATUS,CASE_STATUS\n" + rows)
    out = compile_lca(spark, tmp_root)
    assert {r["case_number"]: r["case_status"] for r in out.collect()} == {"A": "x", "B": "y", "C": "z"}
    from recordlake.config.lca import ALIASES
    from recordlake.operators.headers import resolve_names
    from recordlake.plans._common import harmonized_union, main_files
    u = harmonized_union(spark, main_files(spark, tmp_root, land=False), ["case_number", "case_status", "year"], resolve_names(ALIASES))
    plan = u._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # the rows once, and their files


def test_permanent_keep_first_sorts_no_wide_rows(spark, tmp_root):
    write(f"{tmp_root}/2019/PERM_FY2019.csv", "CASE_NUMBER,CASE_STATUS\n" + "".join(f",s{i}\n" for i in range(50)) + "k,t\nK,u\n")
    out = compile_perm(spark, tmp_root, ["case_number", "case_status", "year", "form_type"])
    assert sorted((r["case_number"], r["case_status"]) for r in out.collect()) == [("K", "t"), ("NONE", "s0")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min_by" not in plan and "LeftSemi" in plan
