"""Observation files arriving over time -> manifest versions.

Each micro-batch of observations (one row per fetched file) is folded into the
manifest with the same set-based M2/M3 operators as the batch refresh, and the
result is written as the next manifest version. ``trigger(availableNow=True)``
processes whatever has arrived and stops, which fits a monthly schedule; the
checkpoint skips files already folded. Each epoch is entered in a ledger beside the
versions before it is folded: a run that dies between writing a version and committing
its batch folds that batch again into the same version, from the same version before it
and with the same run time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.operators.manifest import (
    MANIFEST_V1_SCHEMA, OBSERVATION_SCHEMA, change_status, epoch_entry, last_observations, load_manifest, manifest_upsert,
    save_manifest, utc_now_iso,
)

#: Observations as they arrive; ``observed_at`` (an ISO time) orders repeated ones of a url.
STREAM_SCHEMA = T.StructType([*OBSERVATION_SCHEMA.fields, T.StructField("observed_at", T.StringType())])


def fold_epoch(spark: SparkSession, batch: DataFrame, manifest_root: str, stream: str, epoch: int, data_root: str = "data") -> int:
    """Fold one epoch of the stream named ``stream`` into its own manifest version; returns the version."""
    version, run_time = epoch_entry(spark, manifest_root, stream, epoch, utc_now_iso())
    manifest, _ = load_manifest(spark, manifest_root, MANIFEST_V1_SCHEMA, before=version)
    obs = last_observations(batch).drop("observed_at")
    # joined by merging: a broadcast would pass the manifest through the driver once an epoch
    new = manifest_upsert(manifest, change_status(obs, manifest.hint("merge")), run_time, data_root=data_root)
    # cut lineage from the version being read before writing the next one
    save_manifest(new.checkpoint(eager=True), manifest_root, version, replay=True)
    return version


def start_manifest_stream(spark: SparkSession, observations_dir: str, manifest_root: str, checkpoint: str,
                          fmt: str = "json", data_root: str = "data", max_files_per_trigger: int | None = None):
    """Start the stream; returns the ``StreamingQuery`` (``awaitTermination()`` to wait)."""
    reader = spark.readStream.schema(STREAM_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(observations_dir)

    from recordlake.session import shared_dir
    shared_dir(spark)

    def fold(batch: DataFrame, epoch_id: int) -> None:
        fold_epoch(spark, batch, manifest_root, hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest(), epoch_id, data_root)

    return (stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def statuses_stream(spark: SparkSession, observations_dir: str, manifest: DataFrame, fmt: str = "json") -> DataFrame:
    """Streaming M2 against a static manifest (stream-static left join)."""
    stream = spark.readStream.schema(STREAM_SCHEMA).format(fmt).load(observations_dir)
    return change_status(stream, manifest).withColumn("observed_at", F.current_timestamp())
