"""Helpers shared by the text operators: row positions, staging, checked broadcasts."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.session import shared_dir, staging_path

#: Rows of a narrow key table (at most about 64 bytes a row) up to which it may be broadcast.
BROADCAST_ROWS = 200_000
#: Characters of text that a Python task works on at once.
CHUNK_CHARS = 4_000_000


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application, so that tasks can
    import them wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="recordlake-code-")) / "recordlake_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        if not (package / "__init__.py").exists():
            z.writestr(f"{package.name}/__init__.py", "")
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so a
    lost executor never recomputes what came before."""
    spark = df.sparkSession
    shared_dir(spark)
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def anchored(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have positions in files; else the same rows, written to the
    shared folder once. Operators that read positions more than once start with this."""
    ship(docs.sparkSession)
    names = docs.columns
    if "_metadata" not in names:
        try:
            docs.select(F.col("_metadata.row_index"))
            return docs
        except AnalysisException:
            pass
    plain = stage(docs.toDF(*[f"c{i}" for i in range(len(names))]), "rows")
    return plain.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n != "_metadata"])


def positioned(docs: DataFrame, **cols) -> DataFrame:
    """``cols`` of each row with ``fh`` and ``row``: a hash of the file's path and the
    row's index in it, a stable identity for rows whatever their ids."""
    return anchored(docs).select(
        *[c.alias(k) for k, c in cols.items()], F.xxhash64(F.col("_metadata.file_path")).alias("fh"),
        F.col("_metadata.row_index").alias("row"))


def whole(docs: DataFrame):
    """All columns of a row as one struct, so that no working column can clash with them."""
    return F.struct(*[col(c) for c in docs.columns])


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast only if a count shows that it is within the bound;
    otherwise Spark joins it by shuffling. ``df`` should be staged and narrow."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Tools that a Python worker keeps for its next tasks: those of one operator, as stages share the process.
WORKER: dict = {}


def give_back() -> None:
    """Return a Python worker's unused memory to the system, for the stages that share its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def chunks(batches: Iterable, column: str = "text", most: int = CHUNK_CHARS) -> Iterator[tuple]:
    """(record batch, texts) with at most about ``most`` characters of text each;
    null texts stay None. No other texts of a batch are Python strings meanwhile. Memory that
    an earlier task or this one left unused is given back."""
    give_back()
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        start, size = 0, 0
        for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
            if size and size + n > most:
                yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, size = i, 0
            size += n
        if start < len(texts):
            yield batch.slice(start), texts.slice(start).to_pylist()
        del batch, texts  # not held while the next is read
    give_back()


def keep_positions(docs: DataFrame, positions: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose (fh, row) is (``left_semi``) or isn't (``left_anti``) in
    ``positions``, with the columns of ``docs``."""
    d = positioned(docs, d=whole(docs))
    out = d.join(small(positions.select("fh", "row")), ["fh", "row"], how)
    return out.select(*[F.col("d")[c].alias(c) for c in docs.columns])
