"""Incremental manifest folding with a file stream (availableNow)."""

import json
import os

from recordlake.operators.manifest import load_manifest
from recordlake.streaming.refresh_stream import start_manifest_stream


def test_stream_folds_observations(spark, tmp_root):
    src = f"{tmp_root}/obs"
    os.makedirs(src)
    rows = [{"url": "u1", "program": "LCA Program", "year": "2024", "filename": "a.xlsx", "fetch_ok": True,
             "etag": "e1", "last_modified": "l1", "sha256": "h1"}]
    with open(f"{src}/batch1.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    q = start_manifest_stream(spark, src, f"{tmp_root}/manifest", f"{tmp_root}/ckpt")
    q.awaitTermination(120)
    m, v = load_manifest(spark, f"{tmp_root}/manifest")
    assert v == 1 and [r["url"] for r in m.collect()] == ["u1"]


def test_streaming_statuses_against_static_manifest(spark, tmp_root):
    from recordlake.operators.manifest import MANIFEST_V1_SCHEMA
    from recordlake.streaming.refresh_stream import statuses_stream
    src = f"{tmp_root}/obs2"
    os.makedirs(src)
    rows = [{"url": "u1", "program": "LCA Program", "year": "2024", "filename": "a.xlsx", "fetch_ok": True,
             "etag": "e1", "last_modified": "l1", "sha256": "h1"},
            {"url": "u2", "program": "PERM Program", "year": "2024", "filename": "b.xlsx", "fetch_ok": False,
             "etag": "e9", "last_modified": "l9", "sha256": None}]
    with open(f"{src}/b.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    man = spark.createDataFrame([("u1", "LCA Program", "2024", "a.xlsx", "p", "h1", "e1", "l1", "t", None)],
                                MANIFEST_V1_SCHEMA)
    q = (statuses_stream(spark, src, man).writeStream.format("memory").queryName("statuses_test")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r["url"]: r["status"] for r in spark.sql("SELECT * FROM statuses_test").collect()}
    assert got == {"u1": "skipped_etag", "u2": "failed"}


def test_an_epoch_that_runs_again_writes_its_own_version(spark, tmp_root):
    from recordlake.streaming.refresh_stream import STREAM_SCHEMA, fold_epoch
    root = f"{tmp_root}/manifest"

    def batch(*rows):
        return spark.createDataFrame([(u, "LCA Program", "2024", "a.xlsx", True, e, "", h, None) for u, e, h in rows], STREAM_SCHEMA)
    assert fold_epoch(spark, batch(("u1", "e1", "h1")), root, "s", 0) == 1
    second = batch(("u1", "e2", "h1"), ("u2", "e9", "h2"))
    assert fold_epoch(spark, second, root, "s", 1) == 2
    first = sorted(map(tuple, load_manifest(spark, root)[0].collect()), key=repr)
    assert fold_epoch(spark, second, root, "s", 1) == 2  # the run died before its batch was committed
    again, version = load_manifest(spark, root)
    assert version == 2 and sorted(map(tuple, again.collect()), key=repr) == first  # checked_at and downloaded_at too
    assert {r["url"]: r["checked_at"] is not None for r in again.collect()} == {"u1": True, "u2": False}
    assert fold_epoch(spark, batch(("u3", "e", "h")), root, "other", 1) == 3
    # a run that died while it wrote its version
    import os
    os.unlink(f"{root}/version=3/_SUCCESS")
    assert fold_epoch(spark, batch(("u3", "e", "h")), root, "other", 1) == 3
    assert load_manifest(spark, root)[0].count() == 3


def test_folding_passes_no_manifest_through_the_driver(spark, tmp_path, monkeypatch):
    """At most EPOCHS versions however many files arrive, and no broadcast in any of them."""
    import recordlake.streaming.refresh_stream as stream
    import recordlake.workloads.streaming as check
    plans = []

    def seen(*args, **kw):
        out = upsert(*args, **kw)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    upsert = stream.manifest_upsert
    monkeypatch.setattr(stream, "manifest_upsert", seen)
    monkeypatch.setattr(check, "EPOCHS", 3)
    rows = [(k, f"https://h.com/{'x' * (k % 3)}{k}", f"page {k}") for k in range(40)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = check.q_manifest_stream_fold(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(coalesce)
    assert {r["url"] for r in got} == {u for k, u, _ in rows if k % 11} and len(got) == len({r["url"] for r in got})
    assert 2 <= len(plans) <= 3 and not any("Broadcast" in p for p in plans)
