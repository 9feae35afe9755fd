"""E1 compile and E2 clean for the labour-condition program."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordlake.config import lca as cfg
from recordlake.config.nulls import PANDAS_DEFAULT_NA_TOKENS
from recordlake.functions import (
    clean_text, coerce_double, coerce_long, coerce_timestamp, standardize_pay_unit, standardize_status,
    standardize_visa_class, standardize_yes_no,
)
from recordlake.functions.text import null_tokens
from recordlake.operators.dedupe import (
    batch_of, dedupe_first_batch, distinct_rows, global_positions, normalize_key_strip_upper,
)
from recordlake.operators.profile import (
    Profiles, column_counts, date_range, frequencies_from, null_percentages_from, run_counts, run_counts_observed,
)
from recordlake.session import written
from recordlake.operators.headers import resolve_names
from recordlake.plans._common import harmonized_union, main_files
from recordlake.sources.files import filter_companion_files
from recordlake.sources.sinks import write_csv


def compile_lca(spark: SparkSession, root: str, *, schema: Sequence[str] = cfg.CANONICAL_COLUMNS,
                aliases=cfg.ALIASES, batch_rows: int = cfg.DEDUPE_BATCH_ROWS, csv_hop_nulls: bool = True,
                null_key: str = "literal", out: str | None = None, ignore_corrupt: bool = False,
                check_rows: bool = False, multiline: bool = True) -> DataFrame:
    """S1 -> S5 -> S7 -> H1..H7 -> H12 -> H11 -> U2 -> U1 -> D2 (-> K1).

    Files with identical raw headers are read as one scan and resolved once
    (one ``select`` per header group); the union is one lazy plan. Dedupe
    keeps a row iff its case number occurs in no earlier ``batch_rows`` batch of
    the load order (year, file, row), as the chunked source did.
    ``csv_hop_nulls`` applies the reader null tokens that the source's CSV
    round trip applied to every column.
    """
    files = main_files(spark, root, filter_companion_files, land=False, check_rows=check_rows, ignore_corrupt=ignore_corrupt,
                       multiline=multiline)
    if not files:
        raise FileNotFoundError(f"no vintage files under {root}")
    # the CSV hop's null tokens: on the columns a vintage has, and on the key
    # only after it is normalised (as the source wrote keys, then read them back)
    hop = null_tokens if csv_hop_nulls else (lambda c: c)
    u = harmonized_union(spark, files, schema, resolve_names(aliases), ignore_corrupt=ignore_corrupt, multiline=multiline,
                         value_fn=lambda name, c: c if name == "case_number" else hop(c))
    key = hop(normalize_key_strip_upper(F.col("case_number"), null_key=null_key))
    u = u.select(*[key.alias(c) if c == "case_number" else F.col(c) for c in schema],
                 F.col("_ord.i").alias("_i"), F.col("_ord.f").alias("_f"), F.col("_ord.b").alias("_b"),
                 F.col("_ord.r").alias("_r"))
    u = global_positions(u, ["_i", "_f", "_b"], "_r")
    u = u.withColumn("_batch", batch_of(F.col("_pos"), batch_rows))
    result = dedupe_first_batch(u, "case_number", "_batch",
                                null_key="keep" if null_key == "keep" else "group").select(*schema)
    if out:
        write_csv(result, out)
    return result


def project_business_columns(df: DataFrame, mapping: dict = cfg.DISPLAY_COLUMNS) -> DataFrame:
    """Keep mapped columns that exist, renamed to display names (source order)."""
    present = [c for c in df.columns if c in mapping]
    return df.select(*[F.col(c).alias(mapping[c]) for c in present])


def standardize_lca(df: DataFrame, on_fraction: str = "raise") -> DataFrame:
    """C2-C9 over the display columns that exist."""
    cols = set(df.columns)

    def conv(name: str):
        c = F.col(f"`{name}`")
        if name == "Status":
            return standardize_status(c)
        if name == "Visa Class":
            return standardize_visa_class(c)
        if name in cfg.DATE_COLUMNS:
            return coerce_timestamp(c)
        if name in cfg.NUMBER_COLUMNS:
            return coerce_double(c)
        if name in cfg.PAY_UNIT_COLUMNS:
            return standardize_pay_unit(c)
        if name in cfg.YES_NO_COLUMNS:
            return standardize_yes_no(c)
        if name in cfg.INTEGER_COLUMNS:
            return coerce_long(c, on_fraction=on_fraction)
        if name in cfg.TEXT_COLUMNS:
            return clean_text(c)
        return c

    return df.select(*[conv(c).alias(c) for c in df.columns if c in cols])


def clean_lca(spark: SparkSession, source, *, out: str | None = None, on_fraction: str = "raise",
              read_tokens=PANDAS_DEFAULT_NA_TOKENS, materialize: bool = True) -> tuple[DataFrame, Profiles]:
    """S3 -> C1 -> C2..C9 -> D3 (-> K1) and the P1-P5 profiles.

    ``source`` is the compiled DataFrame or a CSV path (read as text with the
    reader null tokens). The clean table is written once as Parquet in the shared
    folder (``materialize``), so the write and the profiles read the columns they
    need of it instead of recomputing the whole lineage. Returns (clean DataFrame,
    profiles built on first access).
    """
    if isinstance(source, str):
        from recordlake.sources.files import scan_text_csv
        raw = scan_text_csv(spark, source, usecols=list(cfg.DISPLAY_COLUMNS), tokens=read_tokens)
    else:
        raw = source
    projected = project_business_columns(raw)
    seen = Observation("rows_before")
    if materialize:
        projected = projected.observe(seen, F.count(F.lit(1)).alias("n"))
    clean = distinct_rows(standardize_lca(projected, on_fraction))
    if materialize:
        clean = written(clean, "clean")  # also fills the observed row count
    if out:
        write_csv(clean, out)
    b = {"counts": (lambda: run_counts_observed(spark, seen.get["n"], len(projected.columns), clean))
         if materialize else (lambda: run_counts(projected, clean))}
    if "Decision Date" in clean.columns:
        b["decision_date_range"] = lambda: date_range(clean, "Decision Date")
    freq = [n for n in ("Fiscal Year", "Status", "Visa Class", "Wage Unit", "Full Time", "H-1B Dependent") if n in clean.columns]
    # one scan of the clean table counts for all frequency profiles and null shares
    counts = cache(lambda: written(column_counts(clean, freq), "profile"))
    at = {n: i for i, n in enumerate(clean.columns)}
    for name in freq:
        key = "fiscal_year" if name == "Fiscal Year" else name
        b[key] = (lambda n, k: lambda: frequencies_from(counts(), at[n], by_value=k == "fiscal_year"))(name, key)
    b["null_percentages"] = lambda: null_percentages_from(counts(), clean.columns)
    return clean, Profiles(b)
