"""Align vintages to one schema and stack them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_to_schema(df: DataFrame, schema, default_type: str = "string", keep: Sequence[str] = ()) -> DataFrame:
    """Add missing canonical columns as typed nulls, drop extras, fix order.

    ``schema`` is a list of names (typed ``default_type``) or a ``StructType``.
    ``keep`` names extra columns carried at the end (e.g. ordering metadata).
    One ``select``, never a chain of ``withColumn`` calls.
    """
    present = set(df.columns)
    if isinstance(schema, T.StructType):
        fields = [(f.name, f.dataType) for f in schema.fields]
    else:
        fields = [(n, default_type) for n in schema]
    cols = [F.col(n).cast(t).alias(n) if n in present else F.lit(None).cast(t).alias(n) for n, t in fields]
    return df.select(*cols, *[F.col(k) for k in keep])


def stamp_year(df: DataFrame, year, name: str = "year", cast: str | None = None) -> DataFrame:
    """Set a year column (overwriting a source column of that name).

    ``year`` is a literal or a Column (e.g. derived from ``_metadata.file_path``).
    """
    c = year if isinstance(year, Column) else F.lit(year)
    if cast:
        c = c.cast(cast)
    return df.withColumn(name, c)


def union_vintages(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name of aligned vintages."""
    if not frames:
        raise ValueError("no vintages to union")
    return reduce(lambda a, b: a.unionByName(b), frames)
