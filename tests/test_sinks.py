"""K1-K6 and L5 round trips."""

from recordlake.sources.sinks import (
    append_table, write_csv, write_json_summary, write_parquet, write_partitioned_layout, write_report_csv,
)


def test_sinks_round_trip(spark, tmp_root):
    df = spark.createDataFrame([(" a ", 1, "LCA Program", "2024"), ("b", 2, "PW", "2023")],
                               "s string, n int, program string, year string")
    write_csv(df, f"{tmp_root}/csv")
    write_csv(df, f"{tmp_root}/csv", mode="append")  # K2
    back = spark.read.option("header", True).csv(f"{tmp_root}/csv")
    assert back.count() == 4 and " a " in {r["s"] for r in back.collect()}  # whitespace kept
    write_parquet(df, f"{tmp_root}/pq", partition_by="year")
    assert spark.read.parquet(f"{tmp_root}/pq").count() == 2
    write_json_summary(df.limit(1), f"{tmp_root}/json")
    assert spark.read.json(f"{tmp_root}/json").count() == 1
    write_report_csv(df.select("s"), f"{tmp_root}/report")
    assert spark.read.option("header", True).csv(f"{tmp_root}/report").columns == ["s"]
    write_partitioned_layout(df, f"{tmp_root}/layout")
    import os
    assert os.path.isdir(f"{tmp_root}/layout/program=LCA Program/year=2024")
    spark.sql(f"CREATE TABLE sink_test (s STRING, n INT) USING parquet LOCATION '{tmp_root}/tbl'")
    append_table(df.select("s", "n"), "sink_test")
    append_table(df.select("s", "n"), "sink_test")
    assert spark.table("sink_test").count() == 4
    spark.sql("DROP TABLE sink_test")
