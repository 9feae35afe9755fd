"""The reference's live scenarios (headers, hash) as tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordlake.operators.manifest import (
    MANIFEST_V1_SCHEMA, OBSERVATION_SCHEMA, VERSIONED_SCHEMA, change_status, check_not_null, content_fingerprint,
    create_manifest_table, latest_active, load_manifest, manifest_upsert, plan_downloads, record_failures,
    record_versions, run_summary, save_manifest,
)

RUN = "2026-01-01T00:00:00+00:00"


def manifest(spark, rows):
    return spark.createDataFrame(rows, MANIFEST_V1_SCHEMA)


def obs(spark, rows):
    return spark.createDataFrame(rows, OBSERVATION_SCHEMA)


def m_row(url, sha="h1", etag="e1", lm="l1"):
    return (url, "LCA Program", "2024", "f.xlsx", "data/x", sha, etag, lm, "2025", None)


def o_row(url, ok=True, etag="e1", lm="l1", sha="h1", program="LCA Program"):
    return (url, program, "2024", "f.xlsx", ok, etag, lm, sha)


def test_change_tiers(spark):
    m = manifest(spark, [m_row("etag"), m_row("lm"), m_row("hash"), m_row("changed"), m_row("fail"),
                         m_row("empty", etag="", lm=None)])
    o = obs(spark, [o_row("etag"), o_row("lm", etag="e2"), o_row("hash", etag="e2", lm="l2"),
                    o_row("changed", etag="e2", lm="l2", sha="h2"), o_row("fail", ok=False, etag="e2", lm="l2"),
                    o_row("new"), o_row("empty", etag="", lm="", sha="zz")])
    st = {r["url"]: (r["status"], r["is_new"]) for r in change_status(o, m).collect()}
    assert st == {"etag": ("skipped_etag", False), "lm": ("skipped_lastmod", False), "hash": ("skipped_hash", False),
                  "changed": ("downloaded", True), "fail": ("failed", False), "new": ("downloaded", True),
                  "empty": ("downloaded", True)}


def test_upsert_and_second_run_is_quiet(spark):
    m = manifest(spark, [m_row("hash"), m_row("keep")])
    o = obs(spark, [o_row("hash", etag="e9", lm="l9"), o_row("new", sha="n1", etag="en", lm="ln")])
    new = manifest_upsert(m, change_status(o, m), RUN)
    rows = {r["url"]: r for r in new.collect()}
    assert rows["hash"]["etag"] == "e9" and rows["hash"]["checked_at"] == RUN and rows["hash"]["sha256"] == "h1"
    assert rows["new"]["saved_path"] == "data/LCA Program/2024/f.xlsx" and rows["new"]["downloaded_at"] == RUN
    assert rows["keep"]["etag"] == "e1"
    again = change_status(o, new).collect()
    assert all(r["status"] != "downloaded" for r in again)


def test_load_manifest_fallbacks(spark, tmp_root):
    root = f"{tmp_root}/manifest"
    df, v = load_manifest(spark, root)
    assert v == 0 and df.count() == 0
    save_manifest(manifest(spark, [m_row("a")]), root, 1)
    save_manifest(manifest(spark, [m_row("a"), m_row("b")]), root, 2)
    df, v = load_manifest(spark, root)
    assert v == 2 and df.count() == 2
    # a version without its completion marker is ignored
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    hconf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        save_manifest(manifest(spark, [m_row("z")]), root, 3)
    finally:
        hconf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    df, v = load_manifest(spark, root)
    assert v == 2
    from recordlake.operators.manifest import next_version
    assert next_version(spark, root) == 4  # after the incomplete folder too


def test_a_version_that_lost_a_file_gives_way_to_the_one_before(spark, tmp_root):
    import glob
    import os

    import pytest
    root = f"{tmp_root}/manifest"
    save_manifest(manifest(spark, [m_row("a")]), root, 1)
    save_manifest(manifest(spark, [m_row(u) for u in "abcdef"]).repartition(3), root, 2)
    os.unlink(sorted(glob.glob(f"{root}/version=2/part-*.parquet"))[-1])
    with pytest.warns(UserWarning, match="version 2"):
        df, v = load_manifest(spark, root)
    assert v == 1 and df.count() == 1
    save_manifest(manifest(spark, [m_row("a")]).limit(0), root, 3)
    df, v = load_manifest(spark, root)
    assert v == 3 and df.count() == 0


def versioned(spark, rows):
    return spark.createDataFrame(rows, VERSIONED_SCHEMA)


def v_row(period, url, version, status, path, t):
    ts = dt.datetime(2024, 1, t)
    return ("src", "performance", None, period, url, "f", path, 10, "h", None, None, version, status, None, ts, ts, ts)


def test_versions_failures_and_plan(spark):
    t = versioned(spark, [v_row("P", "u", 1, "replaced", "/p1", 1), v_row("P", "u", 2, "active", "/p2", 2),
                          v_row("P", "w", 1, "active", "/w1", 3)])
    dl = spark.createDataFrame([("P", "u", "f", "/p3", 5, "h3", None, None, dt.datetime(2024, 2, 1)),
                                ("P", "u", "f", "/p4", 5, "h4", None, None, dt.datetime(2024, 2, 2)),
                                ("Q", "n", "f", "/n1", 5, "hn", None, None, dt.datetime(2024, 2, 3))],
                               "period string, url string, filename string, saved_path string, bytes long, "
                               "sha256 string, etag string, last_modified string, downloaded_at timestamp")
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    nt = record_versions(t, dl, "src", "performance", now=now)
    fails = spark.createDataFrame([("P", "w", "f", "timeout")], "period string, url string, filename string, error string")
    nt = record_failures(nt, fails, "src", "performance", now=now)
    got = sorted((r["period"], r["url"], r["version"], r["status"], r["saved_path"]) for r in nt.collect())
    assert got == [("P", "u", 1, "replaced", "/p1"), ("P", "u", 2, "replaced", "/p2"), ("P", "u", 3, "replaced", "/p3"),
                   ("P", "u", 4, "active", "/p4"), ("P", "w", 1, "active", "/w1"), ("P", "w", 1, "failed", ""),
                   ("Q", "n", 1, "active", "/n1")]
    la = {(r["period"], r["url"]): r["version"] for r in latest_active(nt).collect()}
    assert la == {("P", "u"): 4, ("P", "w"): 1, ("Q", "n"): 1}
    req = spark.createDataFrame([("P", "u"), ("P", "w"), ("Z", "z")], "period string, url string")
    stored = spark.createDataFrame([("file:/p4",)], "path string")
    fast = {r["url"]: r["decision"] for r in plan_downloads(req, nt, "fast").collect()}
    safe = {r["url"]: (r["decision"], r["reason"]) for r in plan_downloads(req, nt, "safe", stored).collect()}
    assert fast == {"u": "skip", "w": "skip", "z": "download"}
    assert safe["u"][0] == "skip" and safe["w"] == ("download", "file missing from DBFS") and safe["z"][0] == "download"


def test_save_versions(spark, tmp_root):
    from recordlake.operators.manifest import save_versions
    t = versioned(spark, [v_row("P", "u", 1, "active", "/p1", 1)])
    _, v1 = save_versions(t, f"{tmp_root}/v")
    _, v2 = save_versions(t, f"{tmp_root}/v")
    assert (v1, v2) == (1, 2)


def test_not_null_check(spark):
    t = versioned(spark, [v_row("P", "u", 1, "active", "/p1", 1)])
    assert check_not_null(t).count() == 1
    bad = t.withColumn("url", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NOT NULL"):
        check_not_null(bad).count()


def test_table_defaults(spark, tmp_root):
    create_manifest_table(spark, "m", f"{tmp_root}/tbl_db", database="recordlake_test_db")
    assert spark.catalog.tableExists("recordlake_test_db.m")
    spark.sql("DROP TABLE recordlake_test_db.m")
    create_manifest_table(spark, "test_manifest_defaults", f"{tmp_root}/tbl")
    spark.sql("INSERT INTO test_manifest_defaults (source_id, file_type, period, url, filename, saved_path) "
              "VALUES ('s', 'performance', 'P', 'u', 'f', '/p')")
    r = spark.table("test_manifest_defaults").first()
    assert r["version"] == 1 and r["status"] == "active" and r["created_at"] is not None
    spark.sql("DROP TABLE test_manifest_defaults")


def test_fingerprint_and_summary(spark, tmp_root):
    import hashlib
    p = f"{tmp_root}/f.bin"
    with open(p, "wb") as f:
        f.write(b"hello")
    fp = content_fingerprint(spark.read.format("binaryFile").load(p)).first()
    assert fp["sha256"] == hashlib.sha256(b"hello").hexdigest() and fp["bytes"] == 5
    st = spark.createDataFrame([("LCA Program", "downloaded", True), ("PW x", "failed", False)],
                               "program string, status string, is_new boolean")
    s = run_summary(st, RUN).first()
    assert (s["lca"], s["perm"], s["pw"], s["files_downloaded"], s["files_failed"]) == (True, False, False, 1, 1)


def test_paths_of_every_spelling_match(spark):
    from recordlake.operators.manifest import verify_fingerprints
    names = ["dbfs:/data/a.xlsx", "file:/data/b.xlsx", "file:///data/c.xlsx", "s3a://bucket/d.xlsx", "/data/e.xlsx"]
    manifest = spark.createDataFrame([(n, "h") for n in names], "saved_path string, sha256 string")
    stored = spark.createDataFrame([(n, "h") for n in [*names[:4], "file:/data/e.xlsx"]], "path string, sha256 string")
    assert verify_fingerprints(manifest, stored).count() == 0


def test_load_manifest_raises_when_no_version_can_be_read(spark, tmp_path):
    import pytest
    folder = tmp_path / "version=1"
    folder.mkdir()
    (folder / "_SUCCESS").touch()
    (folder / "part-00000.parquet").write_bytes(b"no parquet file")
    with pytest.warns(UserWarning, match="version 1"), pytest.raises(RuntimeError, match="none of 1"):
        load_manifest(spark, str(tmp_path))


def test_repeated_observations_are_one_fetch(spark):
    from recordlake.operators.manifest import last_observations
    m = manifest(spark, [])
    twice = obs(spark, [o_row("u", sha="h1"), o_row("u", sha="h2"), o_row("v")])
    timed = twice.withColumn("observed_at", F.when(F.col("sha256") == "h1", "2026-01-02").otherwise("2026-01-01"))
    one = last_observations(timed)
    assert {(r["url"], r["sha256"]) for r in one.collect()} == {("u", "h1"), ("v", "h1")}
    assert last_observations(twice).count() == 2
    new = manifest_upsert(m, change_status(one.drop("observed_at"), m), RUN)
    assert sorted(r["url"] for r in new.collect()) == ["u", "v"]
    with pytest.raises(Exception, match="several statuses"):
        manifest_upsert(m, change_status(twice, m), RUN).collect()


def test_versions_of_a_hot_url_are_counted_in_slices(spark):
    from pyspark.sql import functions as F
    from recordlake.operators.manifest import VERSIONED_SCHEMA, record_versions
    from recordlake.operators.ranking import ranked
    df = spark.range(20_000).select(
        F.lit("P").alias("period"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("u"), F.col("id").cast("string")))
        .otherwise("hot").alias("url"), F.lit("f").alias("filename"), F.concat(F.lit("/d/"), F.col("id").cast("string")).alias("saved_path"),
        F.lit(1).cast("long").alias("bytes"), F.lit("h").alias("sha256"), F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"), F.timestamp_seconds(F.col("id") * 7919 % 20_000).alias("downloaded_at"))
    out = record_versions(spark.createDataFrame([], VERSIONED_SCHEMA), df, "s", "t", now=F.lit("2026-01-01").cast("timestamp"))
    hot = out.where("url = 'hot'").orderBy("downloaded_at").select("version", "status").collect()
    assert [r.version for r in hot] == list(range(1, 18_001)) and [r.status for r in hot].index("active") == 17_999
    assert out.where("url <> 'hot'").where("version <> 1 or status <> 'active'").count() == 0
    ordered = df.repartitionByRange("period", "url", "downloaded_at", "saved_path")
    sizes = sorted(r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 1 or sizes[-1] <= 2 * sizes[len(sizes) // 2]  # no task holds the hot url
    got = ranked(spark.createDataFrame([(None, 2), (None, 1), ("a", 1), (None, None)], "k string, o int"), ["k"], ["o"]).collect()
    assert sorted((r.k or "", r.o or 0, r._rank, r._size) for r in got) == [("", 0, 1, 3), ("", 1, 2, 3), ("", 2, 3, 3), ("a", 1, 1, 1)]


def test_stored_files_are_made_and_listed_by_many_tasks(spark, tmp_path):
    """The pages of one input file are not stored by one task, nor are their folders followed by the driver."""
    from pyspark.sql import functions as F
    from recordlake.workloads.manifest import _page_of, _stored_pages, q_verify_stored_files
    rows = [(k, "u", f"<p>{k}</p>") for k in range(60)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    stored = _stored_pages(spark, str(tmp_path)).select("path", "bytes", _page_of("path").alias("page_id"))
    tasks = F.regexp_extract("path", r"/part-(\d+)", 1)
    assert stored.select(tasks).distinct().count() > 1
    assert {r["page_id"]: r["bytes"] for r in stored.collect()} == {k: len(h) + 1 for k, _, h in rows}
    bad = q_verify_stored_files(spark, str(tmp_path)).collect()
    assert {r["page_id"] for r in bad} == {k for k in range(60) if k % 10 == 3 or k % 6 == 0} and len(bad) == 16


def _page_files(spark, tmp_path):
    """Pages, more than tasks, with a null text and a repeated id; the bytes of the file of each id."""
    n = 90 + 8 * spark.sparkContext.defaultParallelism
    rows = [(k, "u", None if k == 7 else f"<p>{k} é</p>") for k in range(n)] + [(5, "u", "<p>5 é</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    return {k: b"" if h is None else h.encode() for k, _, h in rows[:n]} | {5: "<p>5 é</p>\n<p>5 é</p>".encode()}


def _digests(texts):
    import hashlib
    return {k: (len(t) + 1, hashlib.sha256(t + b"\n").hexdigest()) for k, t in texts.items()}


def test_stored_pages_take_one_file_each_and_few_tasks_read_them(spark, tmp_path):
    """Neither a folder nor a checksum file for each page, nor a task for each few files."""
    import os
    from recordlake.workloads.manifest import _page_of, _stored_pages
    expect = _digests(_page_files(spark, tmp_path))
    stored = _stored_pages(spark, str(tmp_path))
    got = stored.select(_page_of("path").alias("k"), "path", "bytes", "sha256").collect()
    assert len(got) == len(expect) and {r["k"]: (r["bytes"], r["sha256"]) for r in got} == expect
    folders = {os.path.dirname(r["path"]) for r in got}
    assert len(folders) < len(expect)
    files = [f for d in folders for f in os.listdir(d.removeprefix("file:"))]
    assert sorted(files) == sorted(f"page_id={k}" for k in expect)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a file a task, as Spark counts
        tasks = _stored_pages(spark, str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks <= max(4 * spark.sparkContext.defaultParallelism, 8) < len(expect)


def test_stored_pages_elsewhere_are_written_by_spark(spark, tmp_path, monkeypatch):
    from recordlake.workloads import manifest as M
    expect = _digests(_page_files(spark, tmp_path))
    monkeypatch.setattr(M, "local_folder", lambda *a: None)
    monkeypatch.setattr(M, "FOLDERS_AT_ONCE", 10)
    got = M.q_stored_file_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(expect) and {r["page_id"]: (r["bytes"], r["sha256"]) for r in got} == expect


def test_local_files_are_those_of_one_attempt(spark, tmp_path):
    """A task that is tried again leaves what it made the first time."""
    import os
    from recordlake.sources.sinks import write_local_files
    df = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("a", b"1")], "name string, content binary").coalesce(1)
    for _ in range(2):
        write_local_files(df, f"{tmp_path}/x")
    assert os.listdir(f"{tmp_path}/x") == ["part-00000"]
    assert {f: open(f"{tmp_path}/x/part-00000/{f}", "rb").read() for f in os.listdir(f"{tmp_path}/x/part-00000")} == {"a": b"11", "b": b"2"}


def test_files_are_scanned_in_parts(spark, tmp_path):
    """Sub-folders are worked through a few at a time; hidden ones are left out; names are no patterns."""
    from recordlake.operators.manifest import scan_fingerprints
    root = tmp_path / "files"
    for folder in ("a", "b[1]", "c*", "d/deep", "e", "_draft-1", ".f", "_k=1"):
        (root / folder).mkdir(parents=True)
        for f in ("x.bin", "y.txt"):
            (root / folder / f).write_bytes(folder.encode())
    expect = {folder: len(folder) for folder in ("a", "b[1]", "c*", "d/deep", "e", "_k=1")}
    for folders in (None, 2, 100):
        got = scan_fingerprints(spark, str(root), name="*.bin", folders=folders).collect()
        assert {r["path"].split("/files/")[1].removesuffix("/x.bin"): r["bytes"] for r in got} == expect and len(got) == len(expect)
    assert all(f.endswith(".parquet") for f in scan_fingerprints(spark, str(root), name="*.bin", folders=2).inputFiles())
    (root / "z.bin").write_bytes(b"z")  # beside the folders
    got = scan_fingerprints(spark, str(root), name="*.bin", folders=2).collect()
    assert len(got) == len(expect) + 1


def test_stored_pages_are_verified_in_parts(spark, tmp_path, monkeypatch):
    """Also where the driver lists a few folders at a time: stale and lost pages with both digests, no folder a page."""
    import os
    from recordlake.workloads import manifest as M
    digests = {k: h for k, (_, h) in _digests(_page_files(spark, tmp_path)).items()}
    made = []
    monkeypatch.setattr(M, "FOLDERS_AT_ONCE", 10, raising=False)
    monkeypatch.setattr(M, "staging_path", lambda s, name: made.append(f"{tmp_path}/{name}") or made[-1])
    bad = M.q_verify_stored_files(spark, str(tmp_path)).collect()
    assert len(bad) == len({r["page_id"] for r in bad})
    assert {r["page_id"]: (r["sha256"], r["stored_sha256"]) for r in bad} == {
        k: ("stale" if k % 6 == 0 else h, None if k % 10 == 3 else h) for k, h in digests.items() if k % 6 == 0 or k % 10 == 3}
    assert sum(len(folders) for _, folders, _ in os.walk(made[0])) < len(digests)
