"""Streaming check: observations arriving as files are folded into manifest
versions by an ``availableNow`` stream (one micro-batch per file; from ``EPOCHS`` files on, that many
micro-batches, as each writes the whole manifest)."""

from pyspark.sql import functions as F

from recordlake.operators.manifest import MANIFEST_V1_SCHEMA, load_manifest
from recordlake.session import staging_path
from recordlake.streaming.refresh_stream import STREAM_SCHEMA, start_manifest_stream
from recordlake.workloads.manifest import _observations_and_manifest, _sql_base

EPOCHS = 8


def q_manifest_stream_fold(spark, d):
    obs, _ = _observations_and_manifest(spark, d)
    base = staging_path(spark, "stream")
    src = f"{base}/observations"
    # first arrival: half of the files; second arrival: all files again
    obs.where(F.length("url") % 2 == 0).write.mode("append").json(src)
    obs.write.mode("append").json(src)
    files = len(spark.read.schema(STREAM_SCHEMA).json(src).inputFiles())
    q = start_manifest_stream(spark, src, f"{base}/manifest", f"{base}/checkpoint", max_files_per_trigger=max(1, -(-files // EPOCHS)))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    manifest, _ = load_manifest(spark, f"{base}/manifest", MANIFEST_V1_SCHEMA)
    return manifest.select("url", "program", "year", "filename", "saved_path", "sha256", "etag", "last_modified")


SQL_STREAM_FOLD = f"""
WITH {_sql_base()}
SELECT url, program, year, filename, 'data/' || program || '/' || year || '/' || filename AS saved_path,
       sha256, etag, last_modified
FROM obs WHERE fetch_ok
"""

QUERIES = {"manifest_stream_fold": q_manifest_stream_fold}
ORACLE = {"manifest_stream_fold": SQL_STREAM_FOLD}
