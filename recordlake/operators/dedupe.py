"""Key normalisation and deduplication.

Every keep-first operator carries an explicit total order, because a bare
``dropDuplicates`` keeps an arbitrary row.

Skew: any key may hold a large share of all rows (null keys collapse to one
literal, T3). The operators are built so that no single task ever receives a
whole hot key group:

* D1/D4 use ``min_by`` aggregates on narrow rows, which Spark evaluates partially on
  the map side; each map task ships at most one row per key. Wide rows with a long
  position use ``dedupe_keep_first_at``: the smallest position per key, then a semi join.
* D2 joins rows to the per-key minimum batch on (key, batch), so a hot key is
  spread over its batches and a task holds at most one batch of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.functions._col import as_col
from recordlake.functions.text import ustrip
from recordlake.session import shared_dir, staging_path


def normalize_key_strip_upper(c, null_key: str = "literal", literal: str = "NONE") -> Column:
    """Text -> strip -> upper. ``null_key="literal"`` turns a null key into
    ``NONE`` (what ``str(None).upper()`` gives); ``"keep"`` leaves it null."""
    k = F.upper(ustrip(as_col(c).cast("string")))
    return F.coalesce(k, F.lit(literal)) if null_key == "literal" else k


def normalize_key_upper(c, null_key: str = "literal", literal: str = "NONE") -> Column:
    """Text -> upper, no strip."""
    k = F.upper(as_col(c).cast("string"))
    return F.coalesce(k, F.lit(literal)) if null_key == "literal" else k


def _order_struct(order: Sequence) -> Column:
    return F.struct(*[as_col(o).alias(f"_o{i}") for i, o in enumerate(order)])


def dedupe_keep_first(df: DataFrame, key: str, order: Sequence, null_key: str = "group") -> DataFrame:
    """One row per ``key``: the first by ``order`` (a total order, e.g.
    year, file, row index).

    Implemented as ``groupBy(key).agg(min_by(struct(row), struct(order)))``:
    partial aggregation runs before the shuffle, so a hot key costs one row per
    map task. ``null_key="keep"`` lets rows with a null key bypass the dedupe
    (they are split off before the aggregate); ``"group"`` treats null as one key.
    """
    cols = df.columns
    payload = F.struct(*[F.col(c) for c in cols])
    if null_key == "keep":
        nulls = df.where(F.col(key).isNull())
        body = df.where(F.col(key).isNotNull())
    else:
        nulls, body = None, df
    first = (body.groupBy(F.col(key).alias("_k"))
             .agg(F.min_by(payload, _order_struct(order)).alias("_row"))
             .select("_row.*"))
    return first if nulls is None else first.unionByName(nulls)


def dedupe_keep_first_at(df: DataFrame, key: str, position: str, null_key: str = "group") -> DataFrame:
    """D1 for wide rows: one row per ``key``, the one with the smallest ``position`` (a long, different in every row).

    Two phases: the smallest position per key, a hash aggregate on a long that is combined before its narrow
    shuffle, then a semi join of the rows on position. Rows are joined by a value that no two share, so a key that
    holds most rows (``NONE``) is spread evenly, and no wide row is sorted before it is shuffled. Null keys are one
    key, or with ``null_key="keep"`` all stay.
    """
    if null_key == "keep":
        nulls = df.where(F.col(key).isNull())
        return dedupe_keep_first_at(df.where(F.col(key).isNotNull()), key, position).unionByName(nulls)
    firsts = df.groupBy(key).agg(F.min(position).alias("_first")).select("_first")
    return df.join(firsts, F.col(position) == F.col("_first"), "left_semi")


def dedupe_first_batch(df: DataFrame, key: str, batch: str, null_key: str = "group") -> DataFrame:
    """A row survives iff its key occurs in no earlier batch; duplicates
    inside that first batch all survive. Null keys count as one key.

    Plan: partial-aggregated ``min(batch)`` per key, then a left-semi join on
    (key, batch) = (key, min batch). The join is keyed on the pair, so a hot key
    is spread over its batches instead of landing in one task.
    ``null_key="keep"`` lets rows with a null key bypass the dedupe.
    """
    if null_key == "keep":
        nulls = df.where(F.col(key).isNull())
        return dedupe_first_batch(df.where(F.col(key).isNotNull()), key, batch).unionByName(nulls)
    k = F.coalesce(F.col(key).cast("string"), F.lit("\u0000null"))
    keyed = df.withColumn("_dk", k)
    firsts = keyed.groupBy("_dk").agg(F.min(batch).alias("_db"))
    return (keyed.join(firsts, (keyed["_dk"] == firsts["_dk"]) & (keyed[batch] == firsts["_db"]), "left_semi")
            .drop("_dk"))


def batch_of(position, batch_rows: int) -> Column:
    """Batch number of a 0-based global row position."""
    return F.floor(as_col(position) / F.lit(batch_rows)).cast("long")


def global_positions(df: DataFrame, segment: Sequence[str], row: str, name: str = "_pos",
                     materialize: bool = True) -> DataFrame:
    """Dense 0-based position of every row in (segment..., row) order.

    ``segment`` columns identify ordered chunks (file ordinal, part file, split
    start) and ``row`` increases by one per row inside a chunk (Parquet's
    ``_metadata.row_index``, or a monotonically increasing id within a split).
    The first segment column is the file level: offsets are summed per file
    (a window partition per file) and over per-file totals (one row per file). Chunk sizes are one small aggregate (one row per
    chunk); their running offsets come from a window over that small table and
    are joined back on the chunk key. No task ever sees more than its own rows.
    """
    sizes = df.groupBy(*segment).agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_m0"))
    top, rest = segment[0], list(segment[1:])
    before = (Window.unboundedPreceding, -1)
    # running offsets in two levels: chunks inside their file (one window
    # partition per file), then files (one row per file)
    if rest:
        inner = sizes.withColumn("_in", F.coalesce(F.sum("_n").over(
            Window.partitionBy(top).orderBy(*rest).rowsBetween(*before)), F.lit(0)))
    else:
        inner = sizes.withColumn("_in", F.lit(0).cast("long"))
    files = sizes.groupBy(top).agg(F.sum("_n").alias("_fn"))
    files = files.select(top, F.coalesce(F.sum("_fn").over(Window.orderBy(top).rowsBetween(*before)),
                                         F.lit(0)).alias("_fo"))
    offsets = (inner.join(files, [top], "left")
               .select(*segment, (F.col("_fo") + F.col("_in")).alias("_off"), "_m0"))
    if materialize:
        # one row per chunk, written once; Spark broadcasts it if its size allows
        shared_dir(df.sparkSession)
        target = staging_path(df.sparkSession, "offsets")
        offsets.write.parquet(target)
        offsets = df.sparkSession.read.schema(offsets.schema).parquet(target)
    return (df.join(offsets, list(segment), "left")
            .withColumn(name, F.col("_off") + F.col(row) - F.col("_m0")).drop("_off", "_m0"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """D3: drop fully identical rows (nulls compare equal)."""
    return df.distinct()


def dedupe_by_priority(df: DataFrame, key: str, priority: Sequence) -> DataFrame:
    """One row per ``key``, the best by ``priority`` (e.g. section rank, position)."""
    return dedupe_keep_first(df, key, priority)


def anti_join_seen(new: DataFrame, seen: DataFrame, on) -> DataFrame:
    """A1: rows of ``new`` whose key is not in ``seen`` (incremental load)."""
    return new.join(seen, on, "left_anti")
