"""Keys already loaded, kept in buckets (A1 for incremental loads).

A ledger is a catalog table of keys, bucketed and sorted by them. A new batch is shuffled
into the ledger's buckets and merged with them; the ledger itself, which grows with every
load, is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new ledger; each should stay small enough for one task.
BUCKETS = 64


def append_keys(keys: DataFrame, ledger: str, on: str, location: str | None = None, buckets: int = BUCKETS) -> None:
    """Enter the distinct non-null values of ``on`` that the ledger doesn't hold yet. The first call makes the table, at
    ``location`` if given; later ones must use its number of buckets."""
    spark = keys.sparkSession
    new = keys.select(on).where(F.col(on).isNotNull()).distinct()
    if spark.catalog.tableExists(ledger):
        new = anti_join_ledger(new, ledger, on)
        # dealt into the buckets, so that each gets one more file
        new = new.repartition(buckets, on)
    writer = new.write.format("parquet").bucketBy(buckets, on).sortBy(on).mode("append")
    (writer.option("path", location) if location else writer).saveAsTable(ledger)


def anti_join_ledger(new: DataFrame, ledger: str, on: str) -> DataFrame:
    """Rows of ``new`` whose key isn't in the ledger. Rows with a null key stay: they have no key to be found by, so they
    don't join (where they would be one hot key)."""
    seen = new.sparkSession.table(ledger).select(on)
    fresh = new.where(F.col(on).isNotNull()).join(seen, on, "left_anti")
    return fresh.unionByName(new.where(F.col(on).isNull()))


def drop_ledger(spark: SparkSession, ledger: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {ledger}")
