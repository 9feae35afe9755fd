"""E5 compile for the prevailing-wage program."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.config import pw as cfg
from recordlake.operators.align import align_to_schema, stamp_year, union_vintages
from recordlake.operators.headers import mapping_table_rename, select_slots, to_positional, unmapped_column_report, unmapped_values
from recordlake.sources.files import load_mapping_table, pick_main_file, vintage_scan
from recordlake.sources.sinks import write_parquet, write_report_csv


def _read(spark: SparkSession, path: str, extension: str) -> DataFrame:
    if extension == ".parquet":
        return spark.read.parquet(path)
    from recordlake.sources.files import scan_text_csv
    return scan_text_csv(spark, path, tokens=None)


def compile_pw(spark: SparkSession, root: str, mapping_path: str, *, target_year: int = cfg.TARGET_SCHEMA_YEAR,
               ignored=cfg.IGNORED_COLUMNS_BY_YEAR, on_conflict: str = "error", strict: bool = True,
               out: str | None = None, report_out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """E5: S9 -> S8 -> S1 -> S6 -> H9 -> H10 -> H11 -> H12 -> U1 (-> K3, K5).

    Headers are not normalised (names are case-sensitive here). The target
    schema is the main file of ``target_year``, read from its footer. Two
    headers mapping to one target in one file (T11) fail by default
    (``on_conflict="first"`` keeps the first). Per-year errors are collected;
    with ``strict=True`` they are raised at the end, otherwise reported as
    warnings and the year is skipped. The report also counts the values of each
    unmapped column (``N_VALUES``; not in the written report, whose columns are fixed).
    """
    mapping = load_mapping_table(spark, mapping_path, cfg.MAPPING_SOURCE_COLUMN, cfg.MAPPING_TARGET_COLUMN)
    listing = vintage_scan(spark, root, extensions=(".parquet", ".xlsx", ".csv"))
    # Parquet first, as in the source; a CSV sibling before a spreadsheet because
    # spreadsheets have no Spark reader here
    mains = {r["year"]: r for r in pick_main_file(listing, extension_order=(".parquet", ".csv", ".xlsx")).collect()}
    tgt = mains.get(str(target_year))
    if tgt is None:
        raise FileNotFoundError(f"no main data file for the target year {target_year}")
    target: T.StructType = _read(spark, tgt["path"], tgt["extension"]).schema
    frames, unmapped, errors = [], {}, []
    for year in sorted(int(y) for y in mains if y.isdigit()):
        f = mains[str(year)]
        try:
            if f["extension"] not in (".parquet", ".csv"):
                raise ValueError(f"no Spark reader for {f['extension']} files")
            df = _read(spark, f["path"], f["extension"])
            r = mapping_table_rename(df.columns, mapping, target.fieldNames(), ignored.get(year, ()))
            if r.conflicts and on_conflict == "error":
                raise ValueError(f"year {year}: several headers map to one column: {r.conflicts}")
            seen, slots = set(), []
            for s in r.slots:
                if s.name not in seen:
                    seen.add(s.name)
                    slots.append(s)
            h = select_slots(to_positional(df), slots)
            frames.append(stamp_year(align_to_schema(h, target), year, cfg.SOURCE_YEAR_COLUMN, cast="int"))
            if r.unmapped:
                unmapped[year] = (df, r.unmapped)
        except Exception as e:  # noqa: BLE001 - collected and reported below (T16)
            errors.append((year, e))
    if errors:
        msg = "; ".join(f"{y}: {e}" for y, e in errors)
        if strict:
            raise RuntimeError(f"prevailing-wage compile failed for some years: {msg}")
        warnings.warn(f"skipped years: {msg}")
    result = union_vintages(frames)
    report = unmapped_values(unmapped)
    if report is None:
        report = unmapped_column_report(spark, {}).withColumn("N_VALUES", F.lit(0).cast("long"))
    if out:
        write_parquet(result, out, partition_by=cfg.SOURCE_YEAR_COLUMN)
    if report_out:
        write_report_csv(report.select("COLUMN_NAME", "YEARS_APPEARED"), report_out)
    return result, report
