"""Sinks (K1-K6). Writes go through Spark's commit protocol, except ``write_local_files``; no ``coalesce(1)``."""

from __future__ import annotations

import os
import shutil
import uuid

from pyspark import TaskContext
from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1 (and K2 with ``mode="append"``): CSV with a header, no index; values
    are written as they are (Spark's writer trims whitespace unless told not to)."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite",
                  replace_partitions: bool = False) -> None:
    """K3: Parquet, optionally partitioned (e.g. by ``SOURCE_YEAR``). With ``replace_partitions`` only the
    partitions that ``df`` holds are overwritten, so one year can be loaded again beside the others."""
    w = df.write.mode(mode)
    if replace_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_json_summary(df: DataFrame, path: str) -> None:
    """K4: run summary as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """K5: a small report (e.g. unmapped columns) as CSV, header included."""
    write_csv(df, path)


def append_table(df: DataFrame, table: str) -> None:
    """K6: append to a catalog table, by column name: columns that ``df`` lacks get the table's defaults,
    and a null in a NOT NULL column of the versioned manifest fails the write."""
    from recordlake.operators.manifest import check_not_null
    spark = df.sparkSession
    view = f"append_{uuid.uuid4().hex}"
    check_not_null(df).createOrReplaceTempView(view)
    try:
        names = ", ".join("`" + c.replace("`", "``") + "`" for c in df.columns)
        spark.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def write_partitioned_layout(df: DataFrame, path: str, keys=("program", "year")) -> None:
    """``{root}/{program}/{year}/...`` as a partitioned write."""
    df.write.mode("overwrite").partitionBy(*keys).parquet(path)


def write_local_files(df: DataFrame, root: str) -> None:
    """A file for each ``name`` of (name, content binary) below the local folder ``root`` that all executors share,
    in a folder for each task: ``root/part-00012/<name>``. Rows of one name must be in one partition; their contents
    follow each other. Spark's writers start two ``chmod`` processes for each file on a local file system (for it and
    for its checksum file), which takes far longer than the file, so the tasks write these files themselves. A task's
    folder gets its name when it is whole, once, however often the task is tried."""
    def store(batches):
        task = TaskContext.get()
        folder = f"{root}/part-{task.partitionId():05d}"
        draft = f"{root}/_draft-{task.partitionId():05d}-{task.taskAttemptId()}"  # no reader looks below "_"
        for batch in batches:
            os.makedirs(draft, exist_ok=True)
            for name, content in zip(batch["name"], batch["content"]):
                with open(f"{draft}/{name.as_py()}", "ab") as f:
                    f.write(content.as_py())
        if os.path.isdir(draft):
            try:
                os.rename(draft, folder)
            except OSError:  # another attempt has ended
                if not os.path.isdir(folder):
                    raise
                shutil.rmtree(draft)
        yield from ()

    df.select("name", "content").mapInArrow(store, "name string").write.format("noop").mode("overwrite").save()
