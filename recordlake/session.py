"""Session helpers: a configured session and the shared staging folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "recordlake",
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE with skew
    handling, no UI. On a cluster, pass only what differs from its defaults."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # no Python call-site capture per Column call (plans here build many columns)
         .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (storage every executor sees); an error says so
    where it isn't. With a local master a folder is created and registered here.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[[^-]*\])?$", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="recordlake-ckpt-")
        sc.setCheckpointDir(d)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def written(df, name: str):
    """``df`` as a Parquet table in the shared folder: lineage ends there, and later reads are pruned."""
    spark = df.sparkSession
    target = staging_path(spark, name)
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for intermediate tables."""
    return f"{shared_dir(spark)}/recordlake/{name}-{uuid.uuid4().hex[:12]}"


def local_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` as ``open`` takes it, if it is on the local file system (which executors share where the shared
    folder is there); else None."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None
