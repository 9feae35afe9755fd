"""E3 compile and E4 clean for the permanent-certification program."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordlake.config import perm as cfg
from recordlake.config.nulls import PANDAS_DEFAULT_NA_TOKENS
from recordlake.functions import clean_upper_text, coerce_timestamp, standardize_status
from recordlake.functions.text import null_tokens
from recordlake.operators.dedupe import dedupe_keep_first_at, distinct_rows, global_positions, normalize_key_upper
from recordlake.operators.profile import (
    Profiles, column_counts, date_range, frequencies_from, run_counts, run_counts_observed,
)
from recordlake.session import written
from recordlake.operators.headers import detect_form_type, resolve_names
from recordlake.plans._common import harmonized_union, main_files, union_schema
from recordlake.sources.sinks import write_csv


def form_type_of(filename: str, year: str, last_old_year: int = cfg.LAST_OLD_FORM_YEAR):
    """H13 for one file (a plan-time constant): ``old``/``new``, None for a
    non-numeric year folder (T14)."""
    if "old_form" in filename.lower():
        return "old"
    try:
        y = int(year)
    except ValueError:
        warnings.warn(f"{filename}: year folder {year!r} is not a number; form type left empty")
        return None
    return "old" if y <= last_old_year else "new"


def compile_perm(spark: SparkSession, root: str, schema: Sequence[str] | None = None, *, aliases=cfg.ALIASES,
                 alias_policy: str = "sequential_move", null_key: str = "literal",
                 out: str | None = None, ignore_corrupt: bool = False, check_rows: bool = False,
                 multiline: bool = True) -> DataFrame:
    """S1 -> H13 -> S7 -> H1..H4 -> H8 -> H12 -> H11 -> U1 -> U3 -> D1 (-> K1).

    ``schema`` is the canonical column list; without it, the ordered union of
    the resolved headers of all vintages is used (then ``year``, ``form_type``).
    The default alias
    policy is the literal sequential move (T1); ``"first_wins"`` is the
    documented intent. One row per case number survives: the first in
    (year, file, row) order.
    """
    files = main_files(spark, root, land=False, check_rows=check_rows, ignore_corrupt=ignore_corrupt, multiline=multiline)
    if not files:
        raise FileNotFoundError(f"no vintage files under {root}")
    for f, _ in files:
        form_type_of(f["file_name"], f["year"])  # warns about year folders that are not numbers (T14)
    resolve = resolve_names(aliases, repeat_group_prefixes=(), second_site_prefixes=(), alias_policy=alias_policy)
    if schema is None:
        schema = union_schema(spark, files, resolve, extra=("year", "form_type"))
    u = harmonized_union(spark, files, schema, resolve,
                         per_file=lambda year, name: {"form_type": detect_form_type(name, year)},
                         ignore_corrupt=ignore_corrupt, multiline=multiline)
    if "case_number" in schema:
        u = u.withColumn("case_number", normalize_key_upper(F.col("case_number"), null_key=null_key))
        u = u.select(*schema, F.col("_ord.i").alias("_i"), F.col("_ord.f").alias("_f"), F.col("_ord.b").alias("_b"),
                     F.col("_ord.r").alias("_r"))
        u = dedupe_keep_first_at(global_positions(u, ["_i", "_f", "_b"], "_r"), "case_number", "_pos",
                                 null_key="keep" if null_key == "keep" else "group")
    result = u.select(*schema)
    if out:
        write_csv(result, out)
    return result


def clean_perm(spark: SparkSession, source, *, out: str | None = None,
               read_tokens=PANDAS_DEFAULT_NA_TOKENS, materialize: bool = True) -> tuple[DataFrame, Profiles]:
    """S3 -> C1 -> C2 (permanent variant) -> C6 -> C10 -> D3 (-> K1), P1-P3.

    As in E2, the clean table is materialised once and the profiles read it."""
    if isinstance(source, str):
        from recordlake.sources.files import scan_text_csv
        raw = scan_text_csv(spark, source, tokens=read_tokens)
    else:
        raw = source.select(*[null_tokens(F.col(c), read_tokens).alias(c) if dict(source.dtypes)[c] == "string"
                              else F.col(c) for c in source.columns]) if read_tokens else source
    seen = Observation("rows_before")
    if materialize:
        raw = raw.observe(seen, F.count(F.lit(1)).alias("n"))
    present = [c for c in cfg.DISPLAY_COLUMNS if c in raw.columns]
    projected = raw.select(*[F.col(c).alias(cfg.DISPLAY_COLUMNS[c]) for c in present])
    conv = {
        "Status": lambda c: standardize_status(c, variant="perm"),
        "Decision Date": coerce_timestamp,
        "Form Type": clean_upper_text,
        "Current Visa Type": clean_upper_text,
    }
    clean = distinct_rows(projected.select(*[
        conv[c](F.col(f"`{c}`")).alias(c) if c in conv else F.col(f"`{c}`") for c in projected.columns]))
    if materialize:
        clean = written(clean, "clean")
    if out:
        write_csv(clean, out)
    b = {"counts": (lambda: run_counts_observed(spark, seen.get["n"], len(raw.columns), clean))
         if materialize else (lambda: run_counts(raw, clean))}
    if "Decision Date" in clean.columns:
        b["decision_date_range"] = lambda: date_range(clean, "`Decision Date`")
    freq = [n for n in ("Status", "Form Type", "Current Visa Type") if n in clean.columns]
    counts = cache(lambda: written(column_counts(clean.select(*[F.col(f"`{n}`") for n in freq]), freq), "profile"))
    for i, name in enumerate(freq):
        b[name] = (lambda k: lambda: frequencies_from(counts(), k, top=10))(i)
    return clean, Profiles(b)
