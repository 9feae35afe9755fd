"""Profiling (P1-P8): every profile is one aggregate pass, never one job per column."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.config import discovery


def run_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns before/after a stage, and rows removed (one row)."""
    nb = before.agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit("before"))
    na = after.agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit("after"))
    both = nb.unionByName(na)
    return (both.agg(F.max(F.when(F.col("stage") == "before", F.col("n"))).alias("rows_before"),
                     F.max(F.when(F.col("stage") == "after", F.col("n"))).alias("rows_after"))
            .select("rows_before", "rows_after",
                    F.lit(len(before.columns)).alias("columns_before"),
                    F.lit(len(after.columns)).alias("columns_after"),
                    (F.col("rows_before") - F.col("rows_after")).alias("rows_removed")))


def run_counts_observed(spark, rows_before: int, cols_before: int, after: DataFrame) -> DataFrame:
    """P1 when the "before" row count was observed while the stage ran
    (``DataFrame.observe``), so no extra pass over the input is needed."""
    n = after.count()
    return spark.createDataFrame([(int(rows_before), int(n), int(cols_before), len(after.columns),
                                   int(rows_before) - int(n))],
                                 "rows_before long, rows_after long, columns_before int, columns_after int, "
                                 "rows_removed long")


def date_range(df: DataFrame, column: str) -> DataFrame:
    """Min and max of a column, nulls ignored."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def value_frequencies(df: DataFrame, column: str, top: int | None = None,
                      value_alias: str = "value", count_alias: str = "count") -> DataFrame:
    """Count per non-null value, most frequent first (ties by value); ``top``
    keeps the first n (a top-k report)."""
    out = (df.where(F.col(column).isNotNull())
           .groupBy(F.col(column).alias(value_alias))
           .agg(F.count(F.lit(1)).alias(count_alias))
           .orderBy(F.desc(count_alias), F.asc(value_alias)))
    return out.limit(top) if top is not None else out


def frequencies_by_key_order(df: DataFrame, column: str, value_alias: str = "value",
                             count_alias: str = "count") -> DataFrame:
    """Count per non-null value ordered by the value."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias(value_alias))
            .agg(F.count(F.lit(1)).alias(count_alias))
            .orderBy(value_alias))


def null_percentages(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """P5: per column, share of nulls x 100, highest first (ties in column order).

    One wide aggregate row, then unpivoted: the data is scanned once.
    """
    cols = list(columns or df.columns)
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(f"_n{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_pct"))
        for i, c in enumerate(cols)]))
    return (wide.select(stacked.alias("s")).select("s.*")
            .orderBy(F.desc("null_pct"), F.asc("position")))


def column_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P3-P5 in one scan: position, value, n. Of ``columns`` (positions in ``df``) every value is counted, nulls
    included; of the others only nulls; position -1 counts rows. Every row gives one item for each of ``columns`` and
    one for each null elsewhere, counted before the shuffle, so what is shuffled has the size of the result."""
    wanted = set(columns)

    def item(i: int, value) -> Column:
        return F.struct(F.lit(i).alias("position"), value.cast("string").alias("value"))
    none = F.lit(None)
    items = [item(-1, none)]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        items.append(item(i, col) if c in wanted else F.when(col.isNull(), item(i, none)))
    kept = F.filter(F.array(*items), lambda x: x.isNotNull())
    return df.select(F.explode(kept).alias("i")).groupBy("i.position", "i.value").agg(F.count(F.lit(1)).alias("n"))


def frequencies_from(counts: DataFrame, position: int, by_value: bool = False, top: int | None = None) -> DataFrame:
    """P3 (P4 with ``by_value``) of a column from ``column_counts``."""
    out = counts.where((F.col("position") == position) & F.col("value").isNotNull()).select("value", F.col("n").alias("count"))
    out = out.orderBy("value") if by_value else out.orderBy(F.desc("count"), F.asc("value"))
    return out.limit(top) if top is not None else out


def null_percentages_from(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P5 from ``column_counts``."""
    names = counts.sparkSession.createDataFrame(list(enumerate(columns)), "position int, column_name string")
    nulls = counts.where((F.col("position") >= 0) & F.col("value").isNull()).select("position", F.col("n").alias("_nulls"))
    total = counts.where("position = -1").agg(F.max("n")).first()[0]  # None for an empty table, whose shares are null
    share = F.coalesce("_nulls", F.lit(0)) / F.lit(total).cast("double") * 100.0
    out = names.join(nulls, "position", "left")
    return out.select("position", "column_name", share.alias("null_pct")).orderBy(F.desc("null_pct"), F.asc("position"))


def outcome_counts(df: DataFrame, status_col: str = "status",
                   statuses: Sequence[str] = discovery.OUTCOME_STATUSES) -> DataFrame:
    """Rows per outcome over a fixed status list, zero counts included."""
    wide = df.agg(*[F.count_if(F.col(status_col) == s).alias(f"_s{i}") for i, s in enumerate(statuses)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(s).alias("status"), F.col(f"_s{i}").alias("n_files")) for i, s in enumerate(statuses)]))
    return wide.select(stacked.alias("s")).select("s.*")


def program_change_flags(df: DataFrame, program_col: str = "program", is_new_col: str = "is_new",
                         programs=discovery.PROGRAM_KEYS) -> DataFrame:
    """One row, one boolean per program short key: any new file for it."""
    return df.agg(*[
        F.coalesce(F.max((F.col(program_col) == full) & F.col(is_new_col)), F.lit(False)).alias(short)
        for full, short in programs])


def files_per_program(df: DataFrame, program_col: str = "program") -> DataFrame:
    """Candidates per program."""
    return df.groupBy(program_col).agg(F.count(F.lit(1)).alias("n_files"))


class Profiles(Mapping):
    """Named profiles built on first access (each one is a separate job, so
    none is planned or run unless it is asked for)."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
