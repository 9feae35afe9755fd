"""H1-H13 name resolution and the traps T1, T2, T11, T14, T20."""

import pytest
from pyspark.sql import functions as F

from recordlake.config import lca as lca_cfg
from recordlake.config import perm as perm_cfg
from recordlake.operators.align import align_to_schema, stamp_year, union_vintages
from recordlake.operators.headers import (
    Slot, alias_first_wins, alias_sequential_move, drop_duplicate_headers, drop_repeat_group_columns,
    drop_second_site_columns, harmonize_vintage, mapping_table_rename, normalize_header, slots_of,
    unmapped_column_report, detect_form_type,
)


def names(slots):
    return [s.name for s in slots]


def test_normalize_header():
    assert normalize_header(" Case Number ") == "case_number"
    assert normalize_header("CASE-STATUS") == "case_status"
    assert normalize_header("Unnamed: 3") == ""
    assert normalize_header("H-1B_Dependent") == "h_1b_dependent"


def test_duplicates_keep_first_physical():
    s = drop_duplicate_headers([Slot(0, "a"), Slot(1, "b"), Slot(2, "a")])
    assert [(x.index, x.name) for x in s] == [(0, "a"), (1, "b")]


def test_repeat_groups_and_second_site():
    s = slots_of(["worksite_city_1", "worksite_city_2", "worksite_city_10", "worksite_city_x", "pw_wage_level_3"])
    assert names(drop_repeat_group_columns(s)) == ["worksite_city_1", "worksite_city_x"]
    s = slots_of(["city_2", "state_2", "wage_rate_2", "employer_city_2", "pw_2", "city_1"])
    assert names(drop_second_site_columns(s)) == ["employer_city_2", "city_1"]


def test_first_wins_is_physical_order_not_map_order():
    # 'status' comes first physically: its column wins over 'case_status'
    s = alias_first_wins(slots_of(["status", "case_status"]), lca_cfg.ALIASES)
    assert [(x.index, x.name) for x in s] == [(0, "case_status")]


def test_t2_all_null_alias_never_shadows(spark):
    df = spark.createDataFrame([(None, "CERTIFIED", "1")], "Status string, CASE_STATUS string, Case_No string")
    out = harmonize_vintage(df).collect()[0].asDict()
    assert out == {"case_status": "CERTIFIED", "case_number": "1"}


def test_t20_case_colliding_headers(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string").toDF("Status", "STATUS", "Unnamed: 2")
    out = harmonize_vintage(df, drop_all_null=False)
    assert out.columns == ["case_status"]
    assert out.first()[0] == "1"


def test_t1_sequential_move_self_alias_deletes():
    s = slots_of(["employer_name", "emp_business_name", "pw_wage", "job_opp_pwd_number"])
    out = {x.name: x.index for x in alias_sequential_move(s, perm_cfg.ALIASES)}
    # the self-alias of employer_name (first entry) deletes the original; the
    # move from emp_business_name refills it; pw_wage is deleted for good
    assert out == {"employer_name": 1, "pw_track_number": 3}
    fw = {x.name: x.index for x in alias_sequential_move(s, perm_cfg.ALIASES, policy="first_wins")}
    assert fw == {"employer_name": 0, "pw_wage": 2, "pw_track_number": 3}


def test_sequential_move_chains_and_overwrites():
    s = slots_of(["a", "b", "c"])
    out = alias_sequential_move(s, [("a", "x"), ("x", "y"), ("c", "b")])
    assert [(x.index, x.name) for x in out] == [(2, "b"), (0, "y")]


def test_mapping_rename_conflict_and_unmapped():
    r = mapping_table_rename(["EIN", "EMPLOYER_FEIN", "X", "VOIDED_DATE", "Y"],
                             {"EIN": "EMPLOYER_FEIN", "EMPLOYER_FEIN": "EMPLOYER_FEIN", "Y": "NOT_IN_TARGET"},
                             ["EMPLOYER_FEIN"], ignore={"VOIDED_DATE"})
    assert r.conflicts == {"EMPLOYER_FEIN": ["EIN", "EMPLOYER_FEIN"]}
    assert r.unmapped == ["X", "Y"]


def test_unmapped_report(spark):
    rep = unmapped_column_report(spark, {2016: ["B", "A"], 2015: ["A"]}).collect()
    assert [tuple(r) for r in rep] == [("A", "2015, 2016"), ("B", "2016")]


def test_align_and_union(spark):
    a = spark.createDataFrame([("1", "x")], "case_number string, extra string")
    b = spark.createDataFrame([("2",)], "case_number string")
    u = union_vintages([align_to_schema(stamp_year(a, "2020"), ["case_number", "case_status", "year"]),
                        align_to_schema(stamp_year(b, "2021"), ["case_number", "case_status", "year"])])
    assert u.columns == ["case_number", "case_status", "year"]
    assert sorted(tuple(r) for r in u.collect()) == [("1", None, "2020"), ("2", None, "2021")]
    # idempotent
    again = align_to_schema(u, ["case_number", "case_status", "year"])
    assert again.collect() == u.collect()


@pytest.mark.parametrize("fname,year,expected", [
    ("PERM_FY2024.xlsx", "2024", "new"), ("PERM_FY2024_old_form.xlsx", "2024", "old"),
    ("PERM_FY2023.xlsx", "2023", "old"), ("x.xlsx", "unknown_year", None),
    ("x_OLD_FORM.xlsx", "unknown_year", "old")])
def test_detect_form_type(spark, fname, year, expected):
    df = spark.createDataFrame([(fname, year)], "f string, y string")
    assert df.select(detect_form_type(F.col("f"), F.col("y"))).first()[0] == expected
