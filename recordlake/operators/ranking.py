"""Row numbers inside groups without a window over a group.

``row_number() over (partition by key order by ...)`` gives all rows of a key to one
task. Here rows are dealt by range over (key, order), so a key that holds most rows is
cut into slices; counts per (key, slice) give each slice its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlake.session import written


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str = "_rank", size: str = "_size") -> DataFrame:
    """``df`` with each row's number (from 1) in its group by ``order`` and the group's size.

    Null keys are a key like any other, nulls of ``order`` come first; rows that are equal in ``order`` are numbered
    in any order, but once: the sorted rows are written to the shared folder and numbered by their places there.
    """
    by = [*keys, *order]
    ordered = written(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("_slice", F.shiftright("_at", 33))
    # rows of a group stand side by side in a slice, so a row's number there is its place less the first one's
    slices = ordered.groupBy(*keys, "_slice").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*keys)  # one row per slice of a group
    slices = slices.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_s"),
                           (F.sum("_n").over(group.orderBy("_slice")) - F.col("_n") - F.col("_first") + 1).alias("_shift"),
                           F.sum("_n").over(group).alias(size))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    on = F.col("_slice") == F.col("_s")
    for s in same:
        on = on & s
    out = ordered.join(slices, on).withColumn(rank, F.col("_at") + F.col("_shift"))
    return out.select(*df.columns, rank, size)
