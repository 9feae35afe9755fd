from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.operators.headers import (
    contested_columns, drop_all_null_columns, drop_duplicate_headers, normalize_headers, positional_names, slots_of,
)
from recordlake.session import shared_dir, staging_path
from recordlake.sources.files import land_text_parquet, scan_text_csv, vintage_scan
from recordlake.sources.heads import Head, group_names, groups_of, part_places, readable_files, staged_rows


def main_files(spark: SparkSession, root: str, companion_filter=None, land: bool = True, check_rows: bool = False,
               ignore_corrupt: bool = False, multiline: bool = True) -> list[tuple]:
    """List ``root/<year>/<file>``, optionally land CSV files as text Parquet (S4, existing siblings kept), drop
    companions, and choose one readable file per (year, stem) (S7). Returns (listing row, head) pairs in
    (year, name) order. Metadata only, unless ``check_rows``."""
    if land:
        land_text_parquet(spark, vintage_scan(spark, root), skip_existing=True, multiline=multiline)
    listing = vintage_scan(spark, root)
    if companion_filter is not None:
        listing = companion_filter(listing)
    return readable_files(spark, listing, check_rows=check_rows, ignore_corrupt=ignore_corrupt, multiline=multiline)


def union_schema(spark: SparkSession, files: Sequence[tuple], resolve: Callable, normalize: bool = True,
                 extra: Sequence[str] = ("year",)) -> list[str]:
    """A canonical column list by rule: the resolved header names of all
    vintages in first-seen order (load order), then ``extra``. Header metadata only."""
    out: list = []
    for _, group in groups_of(h for _, h in files).items():  # groups stand in the order of their first files
        slots = slots_of(group_names(spark, group))
        if normalize:
            slots = normalize_headers(slots)
        for s in resolve(drop_duplicate_headers(slots)):
            if s.name not in out and s.name not in extra:
                out.append(s.name)
    return out + list(extra)


def _read_group(spark: SparkSession, group: Sequence[Head], names: list[str], multiline: bool,
                ignore_corrupt: bool) -> DataFrame:
    """Rows of a group as text columns _p0.._pN with _fp (file) and _row (part file, split start, row)."""
    paths, slots = [h.path for h in group], positional_names(len(names))
    if group[0].extension == ".parquet":
        raw = spark.read.option("ignoreCorruptFiles", ignore_corrupt).parquet(*paths)
        raw = raw.select("*", F.col("_metadata.file_path").alias("_fp"),
                         F.struct(F.col("_metadata.file_path").alias("f"), F.lit(0).cast("long").alias("b"),
                                  F.col("_metadata.row_index").alias("r")).alias("_row"))
        pos = raw.toDF(*slots, "_fp", "_row")
        return pos.select(*[F.col(c).cast("string").alias(c) for c in slots], "_fp", "_row")
    raw = scan_text_csv(spark, paths, positional=True, names=names, multiline=multiline, ignore_corrupt=ignore_corrupt)
    pos = raw.select("*", F.col("_metadata.file_path").alias("_fp"),
                     F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                              F.monotonically_increasing_id().alias("r")).alias("_row"))
    # a row's place in a text file depends on how files are split into tasks: rows and
    # places are written once, so that no later job sees other places for the same rows
    shared_dir(spark)
    target = staging_path(spark, "text")
    pos.write.parquet(target)
    return spark.read.schema(pos.schema).parquet(target)


def _patterns(pos: DataFrame, places: dict, suspects: Sequence[int], files: int) -> list[frozenset]:
    """H3: for each file of a group the suspect columns that hold a value anywhere in it."""
    counts = pos.groupBy("_fp").agg(*[F.count(F.col(f"_p{i}")).alias(f"_p{i}") for i in suspects])
    out = [set() for _ in range(files)]
    for r in counts.collect():  # one row per data file: metadata-sized
        out[places[r["_fp"]][0]] |= {i for i in suspects if r[f"_p{i}"] > 0}
    return [frozenset(x) for x in out]


def harmonized_union(spark: SparkSession, files: Sequence[tuple], schema: Sequence[str], resolve: Callable,
                     per_file: Callable[[Column, Column], dict] | None = None,
                     normalize: bool = True, drop_all_null: bool = True,
                     ignore_corrupt: bool = False, multiline: bool = True,
                     value_fn: Callable[[str, Column], Column] | None = None) -> DataFrame:
    """Read vintage files (pairs of ``main_files``) grouped by identical raw header lists (one scan per
    group, not per file), resolve headers once per group, and align all groups to ``schema``.

    Every row gets ``year`` (its folder name) and ``_ord`` = (file ordinal in ``files`` order, part file,
    split, row), the load order. ``resolve`` maps slots to output slots (the header rules after H3). The
    all-null test (H3) is one grouped aggregate per header group, only on contested columns; files of a
    group may differ in what is null, so a column that resolves to different slots is picked row by row by
    its file's null pattern, in the same one scan. ``per_file`` returns extra columns computed from
    (year, file name) columns, e.g. a form type. ``multiline=False`` lets Spark split CSV files that have no
    line breaks inside values. ``ignore_corrupt=True`` skips unreadable rows instead of failing (off by
    default: a silently missing vintage changes the result). ``value_fn(name, column)`` transforms the
    columns a vintage has (missing ones stay null).
    """
    order = {h.path: (i, r) for i, (r, h) in enumerate(files)}
    frames = []
    for group in groups_of(h for _, h in files).values():
        names = group_names(spark, group)
        pos = _read_group(spark, group, names, multiline, ignore_corrupt)
        places = part_places(spark, group)
        slots = slots_of(names)
        if normalize:
            slots = normalize_headers(slots)
        slots = drop_duplicate_headers(slots)
        suspects = contested_columns(slots, resolve) if drop_all_null else []
        kept = _patterns(pos, places, suspects, len(group)) if suspects else [frozenset()] * len(group)
        kinds = list(dict.fromkeys(kept))
        others = set(range(len(names))) - set(suspects)
        resolved = [{s.name: s.index for s in resolve(drop_all_null_columns(slots, others | keep) if suspects else slots)}
                    for keep in kinds]
        of = [(*order[h.path], kinds.index(keep)) for h, keep in zip(group, kept)]
        entries = staged_rows(spark, [(f, of[n][0], of[n][1]["year"], of[n][1]["file_name"], of[n][2]) for f, (n, _) in places.items()],
                              "_fp string, _i int, _year string, _file string, _kind int", "entries")
        # every row's file: one row per data file, which Spark broadcasts if its size allows
        part = pos.join(entries, "_fp", "left")
        missing_file = F.raise_error(F.concat(F.lit("no listing entry for "), "_fp")).cast("int")
        part = part.withColumn("_i", F.coalesce("_i", missing_file))

        def picked(name: str) -> Column | None:
            at = [r.get(name) for r in resolved]
            if all(a is None for a in at):
                return None
            if len(set(at)) == 1:
                return F.col(f"_p{at[0]}")
            out = F.lit(None).cast("string")
            for a in sorted({a for a in at if a is not None}):
                out = F.when(F.col("_kind").isin(*[k for k, x in enumerate(at) if x == a]), F.col(f"_p{a}")).otherwise(out)
            return out
        cols = {}
        for name in dict.fromkeys(n for r in resolved for n in r):
            c = picked(name)
            cols[name] = value_fn(name, c) if value_fn is not None else c
        # one select per group: resolved columns, year (H12), per-file
        # columns, typed nulls for the rest of the schema (H11), load order
        cols["year"] = F.col("_year")
        if per_file:
            cols.update(per_file(F.col("_year"), F.col("_file")))
        load = F.struct(F.col("_i").alias("i"), F.col("_row.f").alias("f"), F.col("_row.b").alias("b"), F.col("_row.r").alias("r"))
        missing = F.lit(None).cast("string")  # one typed null, aliased per missing column
        aligned = [(cols[n].cast("string") if n in cols else missing).alias(n) for n in schema]
        frames.append(part.select(*aligned, load.alias("_ord")))
    if not frames:
        raise FileNotFoundError("no readable vintage files")
    out = frames[0]
    for fr in frames[1:]:
        out = out.unionByName(fr)
    return out

