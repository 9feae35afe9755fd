"""S1-S9 on small files, including raw CSV headers."""

import os

from recordlake.sources.files import (
    csv_header, filter_companion_files, land_text_parquet, load_mapping_table, pick_main_file, read_text_vintage,
    scan_text_csv, source_fallback, vintage_scan,
)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_raw_headers_and_tokens(spark, tmp_root):
    p = f"{tmp_root}/2020/a.csv"
    write(p, "Case Number,case number,,STATUS,Status\n1,x,y,NA,ok\n2,,z,NONE,\n")
    assert csv_header(spark, p) == ["Case Number", "case number", "", "STATUS", "Status"]
    df = scan_text_csv(spark, p, positional=True)
    assert [tuple(r) for r in df.collect()] == [("1", "x", "y", None, "ok"), ("2", None, "z", "NONE", None)]
    v = read_text_vintage(spark, p, ".csv")
    assert v.columns == ["Case Number", "case number", "", "STATUS", "Status", "_row"]


def test_listing_filters_and_fallback(spark, tmp_root):
    for name in ["2020/LCA_FY2020.csv", "2020/LCA_FY2020_Appendix_A.csv", "2021/LCA_FY2021.csv",
                 "2021/LCA_FY2021_Worksites.csv", "notes.csv", "2022/readme.txt"]:
        write(f"{tmp_root}/{name}", "case_number\nA\n")
    land_text_parquet(spark, vintage_scan(spark, tmp_root))
    listing = vintage_scan(spark, tmp_root)
    names = sorted(r["file_name"] for r in listing.collect())
    assert "notes.csv" not in names and "readme.txt" not in names
    picked = sorted((r["year"], r["file_name"]) for r in source_fallback(filter_companion_files(listing)).collect())
    assert picked == [("2020", "LCA_FY2020.parquet"), ("2021", "LCA_FY2021.parquet")]
    back = read_text_vintage(spark, f"{tmp_root}/2020/LCA_FY2020.parquet", ".parquet")
    assert [r[0] for r in back.collect()] == ["A"]


def test_pick_main_file_rules(spark):
    rows = [("2015", "PW_FY2015.xlsx", ".xlsx"),                                            # sole file
            ("2020", "PW_Disclosure_Data_FY2020.parquet", ".parquet"), ("2020", "Other.parquet", ".parquet"),
            ("2021", "PW_Disclosure_Data_FY2021.xlsx", ".xlsx"),
            ("2021", "PW_Disclosure_Data_FY2021_Revised_Form.xlsx", ".xlsx"),
            ("2022", "a_Disclosure_Data.xlsx", ".xlsx"), ("2022", "b_Disclosure_Data.xlsx", ".xlsx"),
            ("2023", "x.parquet", ".parquet"), ("2023", "y.parquet", ".parquet"), ("2023", "z.xlsx", ".xlsx"),
            ("2024", "disclosure_data.xlsx", ".xlsx"), ("2024", "other.xlsx", ".xlsx")]
    df = spark.createDataFrame(rows, "year string, file_name string, extension string")
    got = {r["year"]: r["file_name"] for r in pick_main_file(df).collect()}
    assert got == {"2015": "PW_FY2015.xlsx", "2020": "PW_Disclosure_Data_FY2020.parquet",
                   "2021": "PW_Disclosure_Data_FY2021_Revised_Form.xlsx", "2022": "a_Disclosure_Data.xlsx",
                   "2023": "z.xlsx"}


def test_mapping_table_last_duplicate_wins(spark, tmp_root):
    p = f"{tmp_root}/map.csv"
    write(p, "ORIGINAL,FINAL_2025\n A ,X\nB,Y\nA, Z \n")
    assert load_mapping_table(spark, p) == {"A": "Z", "B": "Y"}


def test_csv_row_order_across_splits(spark, tmp_root):
    from pyspark.sql import functions as F
    from recordlake.operators.dedupe import global_positions
    p = f"{tmp_root}/2020/big.csv"
    write(p, "k,v\n" + "".join(f"{i},{'x' * (i % 7)}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_text_vintage(spark, p, ".csv", multiline=False)
        assert df.rdd.getNumPartitions() > 1
        pos = global_positions(df.select("k", F.col("_row.f").alias("f"), F.col("_row.b").alias("b"),
                                         F.col("_row.r").alias("r")), ["f", "b"], "r")
        got = sorted((int(r["_pos"]), int(r["k"])) for r in pos.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i, i) for i in range(3000)]


def test_first_records(spark, tmp_root, monkeypatch):
    from recordlake.sources import heads
    monkeypatch.setattr(heads, "HEAD_BYTES", 8)  # longer headers are read in further steps
    cases = {"a,b\n1,2\n": ["a", "b"], "a,b": ["a", "b"], "": [], "\n\na,b\n1,2": ["a", "b"], '"x\ny","q""r",\n1,2,3\n': ["x\ny", 'q"r', ""],
             "\ufeffcase,näme\r\n1,2\r\n": ["case", "näme"], "é" * 50 + ",z\n": ["é" * 50, "z"]}
    for i, (text, names) in enumerate(cases.items()):
        p = f"{tmp_root}/h/{i}.csv"
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8", newline="") as f:
            f.write(text)
        assert csv_header(spark, p) == names
    assert heads.read_head(spark, f"{tmp_root}/h/none.csv", ".csv").error


def test_landed_files_keep_their_rows_order(spark, tmp_root):
    for y in (2019, 2020):
        write(f"{tmp_root}/{y}/f.csv", "k,K,v\n" + "".join(f"{y}-{i},d,{'x' * (i % 9)}\n" for i in range(2000)))
    write(f"{tmp_root}/2021/empty.csv", "k,K,v\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = land_text_parquet(spark, vintage_scan(spark, tmp_root), multiline=False)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [p.rsplit("/", 2)[1] for p in got] == ["2019", "2020", "2021"]
    assert sorted(os.listdir(tmp_root)) == ["2019", "2020", "2021"]  # nothing left beside
    for y in (2019, 2020):
        parts = sorted(p for p in os.listdir(f"{tmp_root}/{y}/f.parquet") if p.startswith("part-"))
        assert len(parts) > 3
        rows = [r[0] for p in parts for r in spark.read.parquet(f"{tmp_root}/{y}/f.parquet/{p}").select("k").collect()]
        assert rows == [f"{y}-{i}" for i in range(2000)]
    back = spark.read.parquet(f"{tmp_root}/2021/empty.parquet")
    assert back.columns == ["k", "K.1", "v"] and back.count() == 0
