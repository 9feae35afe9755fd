"""Heads of data files: header records of CSV files and footers of Parquet files.

A head is metadata of bounded size. All heads of a listing are read side by side on the
driver through the file system that Spark uses, with no Spark job, so the number of jobs
of a plan depends on the number of different headers, not on the number of files. What
can't be read is reported in the head, so that a plan can choose another file instead.
"""

from __future__ import annotations

import csv
import warnings
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.operators.headers import positional_names
from recordlake.session import shared_dir, staging_path

#: Bytes read of a CSV file at first; more if its header record is longer.
HEAD_BYTES = 1 << 16
THREADS = 16


@dataclass(frozen=True)
class Head:
    """``key``: equal for files that can be read as one (a CSV header record, or the schema text of a Parquet
    footer); ``parts``: the data files of a folder that Spark wrote, or the file itself; ``rows``: a Parquet
    file's row count; ``error``: why the file can't be read, else None."""
    path: str
    extension: str
    key: tuple = ()
    parts: tuple[str, ...] = ()
    rows: int | None = None
    error: str | None = None


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the files in a folder by name, hidden ones left out."""
    p, fs = _fs(spark, path)
    if not fs.getFileStatus(p).isDirectory():
        return [p.toString()]
    found = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(p) if not s.isDirectory()]
    return [f for name, f in sorted(found) if not name.startswith(("_", "."))]


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder by name, hidden ones left out; none if it holds files too or isn't there."""
    p, fs = _fs(spark, path)
    out = []
    for s in fs.listStatus(p) if fs.exists(p) else []:
        name = s.getPath().getName()
        if name.startswith(".") or name.startswith("_") and "=" not in name:  # as Spark has it
            continue
        if not s.isDirectory():
            return []
        out.append(s.getPath().toString())
    return sorted(out)


def first_record(spark: SparkSession, path: str, multiline: bool = True) -> list[str]:
    """First record of a CSV file, as written; with ``multiline`` a quoted cell may hold line breaks."""
    p, fs = _fs(spark, path)
    size = HEAD_BYTES
    while True:
        stream = fs.open(p)
        try:
            data = bytes(stream.readNBytes(size))
        finally:
            stream.close()
        ended = len(data) < size
        text = data.removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace" if ended else "ignore")
        quoted = False
        for i, c in enumerate(text):
            if c == '"' and multiline:
                quoted = not quoted
            elif c in "\r\n" and not quoted:
                if text[:i].strip("\r\n"):
                    return next(csv.reader([text[:i].lstrip("\r\n")], strict=False))
        if ended:
            rest = text.strip("\r\n")
            return next(csv.reader([rest])) if rest else []
        size *= 4


def _footer(spark: SparkSession, path: str) -> tuple[str, int]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        return reader.getFooter().getFileMetaData().getSchema().toString(), reader.getRecordCount()
    finally:
        reader.close()


def read_head(spark: SparkSession, path: str, extension: str, multiline: bool = True) -> Head:
    try:
        parts = tuple(data_files(spark, path))
        if extension == ".csv":
            names = first_record(spark, parts[0], multiline) if parts else []
            return Head(path, extension, tuple(names), parts)
        if extension == ".parquet":
            if not parts:
                raise ValueError("no data files")
            found = [_footer(spark, p) for p in parts]
            return Head(path, extension, tuple(sorted({s for s, _ in found})), parts, sum(n for _, n in found))
        return Head(path, extension, error=f"no Spark reader for {extension} files (land them as CSV or Parquet first)")
    except Exception as e:  # noqa: BLE001 - reported; the caller decides what an unreadable file means
        return Head(path, extension, error=str(getattr(e, "java_exception", None) or e).splitlines()[0][:300])


def read_heads(spark: SparkSession, files: Iterable[tuple[str, str]], multiline: bool = True) -> dict[str, Head]:
    """Heads by path of (path, extension) pairs."""
    with ThreadPoolExecutor(THREADS) as pool:
        return {h.path: h for h in pool.map(lambda f: read_head(spark, f[0], f[1], multiline), list(files))}


def groups_of(heads: Iterable[Head]) -> dict[tuple, list[Head]]:
    """Heads by (extension, key): each group is read as one."""
    out: dict[tuple, list[Head]] = {}
    for h in heads:
        out.setdefault((h.extension, h.key), []).append(h)
    return out


def group_names(spark: SparkSession, group: Sequence[Head]) -> list[str]:
    """Raw column names of a group."""
    if group[0].extension == ".csv":
        return list(group[0].key)
    return spark.read.parquet(group[0].path).columns


def part_places(spark: SparkSession, heads: Sequence[Head]) -> dict[str, tuple[int, int]]:
    """For each data file, spelt as ``_metadata.file_path`` has it, its position in ``heads`` and among that head's parts."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return {path(p).toUri().toString(): (n, k) for n, h in enumerate(heads) for k, p in enumerate(h.parts)}


def staged_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, name: str) -> DataFrame:
    """Metadata rows as a table in the shared folder, so that Spark knows its size."""
    shared_dir(spark)
    target = staging_path(spark, name)
    spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(target)
    return spark.read.schema(schema).parquet(target)


def short_files(spark: SparkSession, heads: Sequence[Head]) -> dict[str, str]:
    """Errors, by path, of Parquet files whose footer is fine but whose rows can't all be decoded: every column of
    every row is read, in one job per group, and counted against the footer."""
    out = {}
    for group in groups_of(h for h in heads if h.extension == ".parquet" and h.error is None).values():
        df = spark.read.option("ignoreCorruptFiles", True).parquet(*[h.path for h in group])
        names = positional_names(len(df.columns))
        df = df.select("*", F.col("_metadata.file_path").alias("_fp")).toDF(*names, "_fp")
        counts = df.groupBy("_fp").agg(F.count("*").alias("n"), F.max(F.xxhash64(*names)).alias("h")).collect()
        places, found = part_places(spark, group), [0] * len(group)
        for r in counts:  # one row per data file
            found[places[r["_fp"]][0]] += r["n"]
        out |= {h.path: f"{n} of {h.rows} rows can be read" for n, h in zip(found, group) if n < h.rows}
    return out


def readable_files(spark: SparkSession, listing: DataFrame, order: Sequence[str] = (".parquet", ".csv", ".xlsx"),
                   check_rows: bool = False, ignore_corrupt: bool = False, multiline: bool = True) -> list[tuple]:
    """One (listing row, head) per (year, stem), in (year, name) order: the first format in ``order`` that can be
    read, with a warning for each better one that can't. By default a file is readable if its header or footer is;
    ``check_rows`` also decodes every row of Parquet files that have a sibling. Where no format can be read an error
    is raised, or with ``ignore_corrupt`` a warning given."""
    rank = {e: i for i, e in enumerate(order)}
    rows = sorted(listing.collect(), key=lambda r: (r["year"], r["stem"], rank.get(r["extension"], len(order)), r["file_name"]))
    heads = read_heads(spark, [(r["path"], r["extension"]) for r in rows], multiline)
    choices: dict[tuple, list] = {}
    for r in rows:
        choices.setdefault((r["year"], r["stem"]), []).append(r)
    short = {}
    if check_rows:
        short = short_files(spark, [heads[r["path"]] for some in choices.values() if len(some) > 1 for r in some])
    out = []
    for some in choices.values():
        failed = []
        for r in some:
            error = heads[r["path"]].error or short.get(r["path"])
            if error is None:
                out.append((r, heads[r["path"]]))
                break
            failed.append(f"{r['path']}: {error}")
        else:
            if not ignore_corrupt and not all(r["extension"] == ".xlsx" for r in some):
                raise OSError("no readable file: " + "; ".join(failed))
        for f in failed:
            warnings.warn(f"skipping unreadable file {f}")
    return sorted(out, key=lambda x: (x[0]["year"], x[0]["file_name"]))
