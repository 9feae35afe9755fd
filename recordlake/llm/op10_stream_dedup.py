"""Operator 10, exact deduplication with streaming state.

A Structured Streaming query folds fingerprints (digest, stable identifier, content
locator) into keyed state that never expires: a table in the shared folder, one row per
digest with the number of its rows and the one that stays. Each epoch writes what it
changes to a folder of its own name, so an epoch that runs again after a crash replaces
its own folder; state of many epochs is merged from time to time. Copies are combined
before the shuffle, so a group that holds a third of all rows costs each task one row.

Digests seen more than once (hits) are checked on full bytes: the texts of hit rows are
grouped by (digest, text), which Spark compares byte by byte, again combined before the
shuffle. A digest with two different texts is split into its texts, each with a state
row of its own.

With ``state_dir`` the state is kept there, and a later call compares its rows with every
row ever seen, by bytes too: the texts of each call are kept beside the state, and a
state row's locator (file and row) leads to its text.

The state was in RocksDB before; every state store of it takes 4 MiB on disk even for a
few rows, which many partitions multiply.

Defined cases: a null text counts as empty and equals an empty one; of equal
texts the row with the largest id stays, of equal ids (null lowest) the one that
comes last by (file hash, row); rows given to two calls count twice; an empty table
gives no rows; other columns are ignored by ``stream_dedup`` and kept by ``drop_copies``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import anchored, col, keep_positions, positioned, small, stage
from recordlake.session import staging_path

#: State folders that are merged into one when there are more.
RUNS = 8
STATE = "digest binary, n long, keeper struct<doc_id:{id},fh:long,row:long,path:string>, texts long, epoch long"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


class State:
    """Keyed state in ``folder``: prints (fingerprints as they arrive), runs (state rows by epoch), texts (what the
    locators lead to, if the state outlives the call) and the stream's own checkpoint."""

    def __init__(self, spark: SparkSession, folder: str, kind: str) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), STATE.format(id=kind)

    def runs(self) -> list[tuple[int, str]]:
        """(epoch, folder) of complete runs, the newest merged one first."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        root = path(f"{self.folder}/runs")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(root) if fs.exists(path(x.getPath(), "_SUCCESS"))]
        merged = max((int(n[1:]) for n in names if n[0] == "m"), default=-1)
        found = [(int(n[1:]), f"{self.folder}/runs/{n}") for n in names if n[0] == "e" and int(n[1:]) > merged]
        return sorted(found + ([(merged, f"{self.folder}/runs/m{merged}")] if merged >= 0 else []))

    def rows(self, before: int | None = None) -> DataFrame | None:
        """The state rows: of each digest those of the last epoch that changed it."""
        found = [f for e, f in self.runs() if before is None or e < before]
        if not found:
            return None
        every = self.spark.read.schema(self.schema).parquet(*found)
        if len(found) == 1:
            return every
        last = every.groupBy(F.col("digest").alias("d")).agg(F.max("epoch").alias("last"))
        return every.join(last, (F.col("digest") == F.col("d")) & (F.col("epoch") == F.col("last")), "left_semi")

    def write(self, rows: DataFrame, epoch: int) -> None:
        rows.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{self.folder}/runs/e{epoch}")
        if len(self.runs()) > RUNS:
            self.rows().write.mode("overwrite").parquet(f"{self.folder}/runs/m{epoch}")


def _me() -> Column:
    return F.struct("doc_id", "fh", "row", "path")


def _fold(state: State, body: DataFrame, kept: DataFrame | None, batch: DataFrame, epoch: int) -> None:
    """Fold a batch of fingerprints into the state. ``body``: digest and text of the call's rows; ``kept``: texts
    of all calls by locator."""
    mine = stage(batch.groupBy("digest").agg(F.count("*").alias("n"), F.max(_me()).alias("keeper")), "epoch")
    old = state.rows(before=epoch)
    known = None if old is None else stage(old.join(mine.select("digest"), "digest", "left_semi"), "known")
    hits = mine.where("n > 1").select("digest")
    if known is not None:
        hits = hits.unionByName(known.select("digest")).distinct()
    hits = small(stage(hits, "hit"))

    def by_locator(rows: DataFrame) -> DataFrame:
        at = rows.select("digest", "n", "keeper", *[F.col(f"keeper.{c}").alias(f"k_{c}") for c in ("path", "fh", "row")])
        here = [F.col(f"k_{c}") == kept[c] for c in ("path", "fh", "row")]
        return at.join(kept, here[0] & here[1] & here[2]).select("digest", kept["text"], "n", "keeper")
    if kept is None:
        texts = body.join(hits, "digest", "left_semi").select("digest", "text", F.lit(1).cast("long").alias("n"), _me().alias("keeper"))
    else:  # the batch may hold rows of an earlier call that did not end
        rows = batch.join(hits, "digest", "left_semi").select("digest", F.lit(1).cast("long").alias("n"), _me().alias("keeper"))
        texts = by_locator(rows)
        if known is not None:
            texts = texts.unionByName(by_locator(known))
    groups = stage(texts.groupBy("digest", "text").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper")).drop("text"), "groups")
    several = groups.groupBy("digest").agg(F.count("*").alias("texts"))
    out = groups.join(several, "digest").select("digest", "n", "keeper", "texts")
    single = mine.join(hits, "digest", "left_anti").withColumn("texts", F.lit(1).cast("long"))
    state.write(out.unionByName(single.select("digest", "n", "keeper", "texts")), epoch)


def stream_dedup(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256, state_dir: str | None = None) -> DataFrame:
    """digest, doc_id, fh, row, keep_id, group_size, kept: one row per row of ``docs``."""
    docs = anchored(docs)
    folder, call = state_dir or staging_path(spark, "state"), uuid.uuid4().hex
    body = positioned(docs, doc_id=col(doc_id), text=F.coalesce(col(text), F.lit("")))
    kept = None
    if state_dir:  # later calls read these texts by their locators
        body.write.parquet(f"{folder}/texts/{call}")
        everything = spark.read.schema(body.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/texts")
        kept = everything.select("fh", "row", "text", F.col("_metadata.file_path").alias("path"))
        body = spark.read.schema(body.schema).parquet(f"{folder}/texts/{call}").withColumn("path", F.col("_metadata.file_path"))
    else:
        body = body.withColumn("path", F.lit(None).cast("string"))
    body = body.withColumn("digest", digest(F.col("text")))
    prints = body.select("digest", "doc_id", "fh", "row", "path")
    prints.write.parquet(f"{folder}/prints/{call}")
    prints = spark.read.schema(prints.schema).parquet(f"{folder}/prints/{call}")
    state = State(spark, folder, dict(prints.dtypes)["doc_id"])
    if prints.take(1):
        arriving = spark.readStream.schema(prints.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/prints")
        query = (arriving.writeStream.foreachBatch(lambda batch, epoch: _fold(state, body, kept, batch, epoch))
                 .option("checkpointLocation", f"{folder}/stream").trigger(availableNow=True).start())
        query.awaitTermination()
    rows = state.rows()
    if rows is None:
        return prints.select("digest", "doc_id", "fh", "row", F.col("doc_id").alias("keep_id"),
                             F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    groups = rows.where("n > 1 or texts > 1")
    if state_dir:
        groups = groups.join(prints.select("digest").distinct(), "digest", "left_semi")
    groups = stage(groups, "groups")

    def result(df: DataFrame) -> DataFrame:
        return df.select("digest", "doc_id", "fh", "row",
                         F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("keep_id"),
                         F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                         F.coalesce(F.col("keeper").eqNullSafe(_me()) | F.col("n").isNull(), F.lit(True)).alias("kept"))
    one = small(groups.where("texts = 1").select("digest", "n", "keeper"))
    if not groups.where("texts > 1").take(1):
        return result(prints.join(one, "digest", "left"))
    # different bytes under one digest: its rows find their state row by the text of the row that stays
    split = groups.where("texts > 1").select("digest", "n", "keeper")
    mine = body.join(split.select("digest").distinct(), "digest", "left_semi")
    whole = mine.select("digest", "text", _me().alias("k")) if kept is None else kept.join(
        split.select(*[F.col(f"keeper.{c}").alias(c) for c in ("path", "fh", "row")], "digest", "keeper"), ["path", "fh", "row"]).select(
        "digest", "text", F.col("keeper").alias("k"))
    by_text = split.join(whole.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & F.col("keeper").eqNullSafe(F.col("k")))
    by_text = by_text.select("digest", "text", "n", "keeper")
    plain = prints.join(split.select("digest").distinct(), "digest", "left_anti")
    return result(plain.join(one, "digest", "left")).unionByName(result(mine.join(by_text, ["digest", "text"])))


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = anchored(docs)
    gone = stage(stream_dedup(spark, docs).where("not kept").select("fh", "row"), "copies")
    return keep_positions(docs, gone, "left_anti")
