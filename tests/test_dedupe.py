"""U2, U3, D1-D4, A1 and the traps T3/T4, including a hot key."""

from pyspark.sql import functions as F

from recordlake.operators.dedupe import (
    anti_join_seen, batch_of, dedupe_by_priority, dedupe_first_batch, dedupe_keep_first, distinct_rows,
    global_positions, normalize_key_strip_upper, normalize_key_upper,
)


def test_key_normalisation(spark):
    df = spark.createDataFrame([(" a-1 ",), (None,)], "k string")
    assert [r[0] for r in df.select(normalize_key_strip_upper("k")).collect()] == ["A-1", "NONE"]
    assert [r[0] for r in df.select(normalize_key_upper("k")).collect()] == [" A-1 ", "NONE"]
    assert [r[0] for r in df.select(normalize_key_upper("k", null_key="keep")).collect()] == [" A-1 ", None]


def test_keep_first_is_ordered_not_arbitrary(spark):
    rows = [("K", i, f"v{i}") for i in range(200)] + [("J", 5, "j5"), ("J", 3, "j3")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(7)
    out = {r["k"]: r["v"] for r in dedupe_keep_first(df, "k", [F.col("o")]).collect()}
    assert out == {"K": "v0", "J": "j3"}


def test_keep_first_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, o int")
    assert dedupe_keep_first(df, "k", [F.col("o")]).count() == 2
    assert dedupe_keep_first(df, "k", [F.col("o")], null_key="keep").count() == 3


def test_hot_key_plan_aggregates_before_shuffle(spark):
    # a third of all rows share one key: the plan must aggregate partially
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
                                   F.col("id"))
    out = dedupe_keep_first(df, "k", [F.col("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2  # partial + final
    assert out.where(F.col("k") == "HOT").first()["id"] == 0
    assert out.count() == 20001


def test_first_batch_semantics(spark):
    # batch 0: a, a, b ; batch 1: a, c ; batch 2: c, b
    rows = [(0, "a"), (1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "c"), (6, "b"), (7, None), (8, None)]
    df = spark.createDataFrame(rows, "pos long, k string").withColumn("batch", batch_of(F.col("pos"), 3))
    kept = sorted(r["pos"] for r in dedupe_first_batch(df, "k", "batch").collect())
    assert kept == [0, 1, 2, 4, 5, 7, 8]
    df2 = df.withColumn("k", F.when(F.col("pos") == 2, F.lit(None)).otherwise(F.col("k")))
    kept = sorted(r["pos"] for r in dedupe_first_batch(df2, "k", "batch").collect())
    assert kept == [0, 1, 2, 4, 5, 6]  # null keys form one key: 7, 8 are in a later batch than 2
    kept = sorted(r["pos"] for r in dedupe_first_batch(df2, "k", "batch", null_key="keep").collect())
    assert kept == [0, 1, 2, 4, 5, 6, 7, 8]


def test_global_positions(spark):
    df = spark.createDataFrame([(1, "f2", 10), (1, "f2", 11), (0, "f9", 0), (1, "f1", 0), (0, "f9", 1)],
                               "i int, f string, r long")
    out = sorted((r["i"], r["f"], r["r"], r["_pos"]) for r in global_positions(df, ["i", "f"], "r").collect())
    assert out == [(0, "f9", 0, 0), (0, "f9", 1, 1), (1, "f1", 0, 2), (1, "f2", 10, 3), (1, "f2", 11, 4)]


def test_distinct_and_priority_and_anti(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "p string, q string")
    assert distinct_rows(df).count() == 2
    c = spark.createDataFrame([("u", 1, 5, "page"), ("u", 0, 9, "table"), ("v", 1, 1, "page")],
                              "url string, section int, pos int, src string")
    best = {r["url"]: r["src"] for r in dedupe_by_priority(c, "url", [F.col("section"), F.col("pos")]).collect()}
    assert best == {"u": "table", "v": "page"}
    new = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    seen = spark.createDataFrame([(2,)], "k int")
    assert sorted(r[0] for r in anti_join_seen(new, seen, "k").collect()) == [1, 3]


def test_first_batch_join_is_keyed_on_key_and_batch(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
        df = spark.range(20000).select(hot.alias("k"), F.col("id").alias("pos"))
        out = dedupe_first_batch(df.withColumn("b", batch_of(F.col("pos"), 1000)), "k", "b")
        plan = out._jdf.queryExecution().executedPlan().toString()
        import re
        flat = " ".join(re.sub(r"#\d+L?", "", plan).split())
        assert re.search(r"SortMergeJoin \[\w+, b\], \[_dk, _db\], LeftSemi", flat), flat
        # the hot key keeps its first batch (334 rows); every other key is unique
        assert out.count() == 334 + (20000 - 6667)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_global_positions_without_broadcast(spark):
    df = spark.createDataFrame([(1, "f2", 10), (1, "f2", 11), (0, "f9", 0), (1, "f1", 0), (0, "f9", 1)],
                               "i int, f string, r long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = global_positions(df, ["i", "f"], "r")  # beyond the bound: plain join
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = sorted((r["i"], r["f"], r["r"], r["_pos"]) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(0, "f9", 0, 0), (0, "f9", 1, 1), (1, "f1", 0, 2), (1, "f2", 10, 3), (1, "f2", 11, 4)]


def test_key_ledger_is_never_shuffled(spark, tmp_root):
    from recordlake.operators.ledger import anti_join_ledger, append_keys, drop_ledger
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
        append_keys(rows, "ledger_test", "k", f"{tmp_root}/ledger", buckets=4)
        new = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z"), (None, "n")], "k long, v string")
        out = anti_join_ledger(new, "ledger_test", "k")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.k or 0, r.v) for r in out.collect()) == [(0, "n"), (3, "y"), (3, "z")]
        side = plan[plan.index("LeftAnti"):]
        assert side.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan  # the new rows alone
        append_keys(new, "ledger_test", "k", buckets=4)
        append_keys(new, "ledger_test", "k", buckets=4)
        assert sorted(r.k for r in spark.table("ledger_test").collect()) == [1, 2, 3]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_ledger(spark, "ledger_test")
