"""E6 refresh: discovery -> change detection -> manifest version -> summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.operators.discover import discover_candidates
from recordlake.operators.manifest import (
    MANIFEST_V1_SCHEMA, change_status, last_observations, load_manifest, manifest_upsert, next_version, run_summary, save_manifest,
    utc_now_iso,
)
from recordlake.operators.profile import outcome_counts
from recordlake.session import shared_dir
from recordlake.sources.sinks import write_json_summary


def refresh(spark: SparkSession, pages: DataFrame, observations: DataFrame, manifest_root: str, *,
            run_time: str | None = None, data_root: str = "data", summary_out: str | None = None,
            save: bool = True) -> dict:
    """E6 as one set-based job.

    ``pages``: (page_id, url, html). ``observations``: what fetching each file
    URL returned (url, fetch_ok, etag, last_modified, sha256 and, where a URL may
    be seen twice, observed_at: the last one counts); fetching itself is outside Spark. The new manifest is written as the next version under
    ``manifest_root``; the one read is never overwritten.
    Returns candidates, statuses, outcome counts, summary and the new manifest.
    """
    run_time = run_time or utc_now_iso()
    cands = discover_candidates(pages)
    fetched = ["url", "fetch_ok", "etag", "last_modified", "sha256"]
    seen = last_observations(observations.select(*fetched, *[c for c in ["observed_at"] if c in observations.columns]))
    obs = cands.join(seen.select(*fetched), "url", "left") \
               .withColumn("fetch_ok", F.coalesce(F.col("fetch_ok"), F.lit(False)))
    manifest, version = load_manifest(spark, manifest_root, MANIFEST_V1_SCHEMA)
    statuses = change_status(obs.select("url", "program", "year", "filename", "fetch_ok", "etag", "last_modified",
                                        "sha256"), manifest)
    # several outputs (manifest, counts, summary) read the statuses: materialise
    # them once in the shared checkpoint folder instead of re-running discovery
    shared_dir(spark)
    statuses = statuses.checkpoint(eager=True)
    new_manifest = manifest_upsert(manifest, statuses, run_time, data_root=data_root)
    new_version = next_version(spark, manifest_root)
    if save:
        save_manifest(new_manifest, manifest_root, new_version)
    summary = run_summary(statuses, run_time)
    if summary_out:
        write_json_summary(summary, summary_out)
    return {"candidates": cands, "statuses": statuses, "outcomes": outcome_counts(statuses),
            "summary": summary, "manifest": new_manifest, "manifest_version": new_version,
            "previous_version": version}
