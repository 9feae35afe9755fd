"""File sources over a vintage layout ``root/<year>/<file>``.

Listings are distributed (``binaryFile`` without its content column), file
choice is a window over the listing, and every data file is read by Spark. The
driver only sees file *metadata* (names, headers), never rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.config.lca import COMPANION_FILE_MARKERS
from recordlake.config.nulls import PANDAS_DEFAULT_NA_TOKENS
from recordlake.functions.text import null_tokens, ustrip
from recordlake.operators.headers import positional_names
from recordlake.sources import heads

def _glob(spark: SparkSession, pattern: str) -> list[tuple[str, bool, int, int]]:
    """(path, is_dir, length, modification ms) of every match of a Hadoop glob."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(conf)
    found = fs.globStatus(path)
    if found is None:
        return []
    return [(st.getPath().toString(), st.isDirectory(), st.getLen(), st.getModificationTime()) for st in found]


def vintage_scan(spark: SparkSession, root: str, extensions: Sequence[str] = (".parquet", ".csv", ".xlsx")) -> DataFrame:
    """Data files inside the year folders of ``root`` (``root/<year>/<file>``),
    with year, name, extension and stem. Year entries that are not folders are
    skipped. A "file" may be a single file or a directory of part files as
    Spark writes them. Only metadata is listed (one glob on the driver, as any
    file source does)."""
    rows = []
    for year_path, is_dir, _, _ in _glob(spark, f"{root.rstrip('/')}/*"):
        if not is_dir or year_path.rstrip("/").rsplit("/", 1)[-1].startswith(("_", ".")):
            continue
        for path, _, length, mtime in _glob(spark, f"{year_path}/*"):
            name = path.rstrip("/").rsplit("/", 1)[-1]
            if name.startswith(("_", ".")):
                continue
            stem, dot, ext = name.rpartition(".")
            ext = f".{ext.lower()}" if dot else ""
            if ext not in {e.lower() for e in extensions}:
                continue
            rows.append((path, year_path.rstrip("/").rsplit("/", 1)[-1], name, ext, stem if dot else name,
                         int(length), int(mtime)))
    df = spark.createDataFrame(rows, "path string, year string, file_name string, extension string, stem string, "
                                     "length long, mtime long")
    return df.select("path", "year", "file_name", "extension", "stem", "length",
                     F.timestamp_millis("mtime").alias("modification_time"))


def filter_companion_files(listing: DataFrame, markers: Sequence[str] = COMPANION_FILE_MARKERS) -> DataFrame:
    """Drop files whose lower-cased name contains a companion marker."""
    low = F.lower(F.col("file_name"))
    cond = None
    for m in markers:
        c = low.contains(m)
        cond = c if cond is None else (cond | c)
    return listing.where(~cond)


def pick_main_file(listing: DataFrame, extension_order: Sequence[str] = (".parquet", ".xlsx"),
                   marker: str = "Disclosure_Data", preferred: Sequence[str] = ("new_form", "revised_form")) -> DataFrame:
    """One main file per year.

    Per extension in ``extension_order``: the sole file of that extension; else
    the sole file containing ``marker`` (case-sensitive); else the first marker
    file whose lower-cased name contains a preferred word; else the first marker
    file; else try the next extension. "First" is name order here (the source
    used directory order). Years with no match have no row.
    """
    ext_rank = F.lit(None).cast("int")
    for i, e in enumerate(extension_order):
        ext_rank = F.when(F.col("extension") == e, F.lit(i)).otherwise(ext_rank)
    l = listing.withColumn("_ext_rank", ext_rank).where(F.col("_ext_rank").isNotNull())
    per_ext = Window.partitionBy("year", "_ext_rank")
    has_marker = F.col("file_name").contains(marker)
    low = F.lower(F.col("file_name"))
    pref = None
    for p in preferred:
        c = low.contains(p)
        pref = c if pref is None else (pref | c)
    l = (l.withColumn("_n_ext", F.count(F.lit(1)).over(per_ext))
         .withColumn("_n_marker", F.sum(has_marker.cast("int")).over(per_ext)))
    rule = (F.when(F.col("_n_ext") == 1, F.lit(0))
            .when(has_marker & (F.col("_n_marker") == 1), F.lit(1))
            .when(has_marker & pref, F.lit(2))
            .when(has_marker, F.lit(3)))
    l = l.withColumn("_rule", rule).where(F.col("_rule").isNotNull())
    best = Window.partitionBy("year").orderBy("_ext_rank", "_rule", "file_name")
    return (l.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") == 1)
            .drop("_ext_rank", "_n_ext", "_n_marker", "_rule", "_rn"))


def source_fallback(listing: DataFrame, order: Sequence[str] = (".parquet", ".csv", ".xlsx")) -> DataFrame:
    """Among files sharing (year, stem), keep the preferred format
    (landed Parquet before the text or spreadsheet original)."""
    rank = F.lit(len(order))
    for i, e in reversed(list(enumerate(order))):
        rank = F.when(F.col("extension") == e, F.lit(i)).otherwise(rank)
    w = Window.partitionBy("year", "stem").orderBy(rank, "file_name")
    return listing.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def schema_only_read(spark: SparkSession, path: str) -> list[str]:
    """Column names of a Parquet file from its footer (no rows read)."""
    return spark.read.parquet(path).columns


def load_mapping_table(spark: SparkSession, path: str, source: str = "ORIGINAL",
                       target: str = "FINAL_2025") -> dict:
    """Two-column header map, trimmed; a later duplicate wins.

    This is configuration (a few hundred header names), so it is collected to
    the driver to build plans.
    """
    df = (spark.read.option("header", True).option("inferSchema", False).csv(path)
          .select(ustrip(F.col(source)).alias("s"), ustrip(F.col(target)).alias("t"),
                  F.monotonically_increasing_id().alias("i")))
    out: dict = {}
    for r in df.orderBy("i").collect():
        out[r["s"] if r["s"] is not None else ""] = r["t"] if r["t"] is not None else ""
    return out


def read_name_list(path: str) -> list[str]:
    """One name per line (a canonical schema kept as a plain text file)."""
    with open(path, encoding="utf-8") as f:
        return [ln.strip() for ln in f if ln.strip()]


def csv_header(spark: SparkSession, path: str, multiline: bool = True) -> list[str]:
    """Raw header row of a CSV file (first record only), exactly as written. ``multiline`` must be
    that of the data's read: a quoted header cell may hold a line break."""
    files = heads.data_files(spark, path)
    return heads.first_record(spark, files[0], multiline) if files else []


def scan_text_csv(spark: SparkSession, path, usecols: Sequence[str] | None = None,
                  tokens: Sequence[str] | None = PANDAS_DEFAULT_NA_TOKENS, positional: bool = False,
                  names: Sequence[str] | None = None, multiline: bool = True,
                  ignore_corrupt: bool = False) -> DataFrame:
    """S3: read a CSV as text with the reader-level null tokens applied.

    Headers are taken verbatim (duplicates, blanks and case are kept; see T20):
    the file is read with a positional all-string schema and the header line
    skipped. With ``positional=True`` columns stay ``_p0.._pN`` for header
    resolution; otherwise they get the header names (``usecols`` subsets them).
    ``multiline=True`` allows quoted values with line breaks, which makes each
    file one task; pass ``False`` for files without them to split large files.
    """
    names = list(names) if names is not None else csv_header(spark, path if isinstance(path, str) else path[0], multiline)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in positional_names(len(names))])
    df = (spark.read.option("header", True).option("enforceSchema", True).option("multiLine", multiline)
          .option("escape", '"').option("ignoreCorruptFiles", ignore_corrupt).schema(schema).csv(path))
    if tokens:
        df = df.select(*[null_tokens(F.col(c), tokens).alias(c) for c in df.columns])
    if positional:
        return df
    keep = [(i, n) for i, n in enumerate(names) if usecols is None or n in set(usecols)]
    return df.select(*[F.col(f"_p{i}").alias(n) for i, n in keep])


def read_text_vintage(spark: SparkSession, path: str, extension: str, multiline: bool = True) -> DataFrame:
    """Read one vintage file as all-text columns, keeping its raw header names
    and adding ``_row``: the position inside the file (part file, split start,
    row), a total order for keep-first rules."""
    if extension == ".parquet":
        df = spark.read.parquet(path)
        names = df.columns
        row = F.struct(F.col("_metadata.file_path").alias("f"), F.lit(0).cast("long").alias("b"),
                       F.col("_metadata.row_index").alias("r"))
        raw = df.select("*", row.alias("_row"))
    elif extension == ".csv":
        names = csv_header(spark, path, multiline)
        df = scan_text_csv(spark, path, positional=True, names=names, multiline=multiline)
        # splits of one file in start-offset order; rows in a split in read order
        row = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                       F.monotonically_increasing_id().alias("r"))
        raw = df.select("*", row.alias("_row"))
    else:
        raise ValueError(f"no Spark reader for {extension} files (land them as CSV or Parquet first)")
    pos = raw.toDF(*positional_names(len(names)), "_row")
    text = pos.select(*[F.col(c).cast("string").alias(c) for c in pos.columns if c != "_row"], "_row")
    return text.toDF(*names, "_row")


def land_text_parquet(spark: SparkSession, listing: DataFrame, skip_existing: bool = False,
                      multiline: bool = True) -> list[str]:
    """Write an all-text Parquet sibling next to each CSV source file.

    Files with equal headers are landed by one job: rows are written to a folder per (file, part, split) and, as no
    task holds more than its own splits, only sorted inside their task; the folders' files then get names in that
    order and are renamed into the siblings, each at once. ``skip_existing=True`` leaves files that already have a
    sibling (a left-anti join of the source listing with the landed listing).
    """
    src = listing.where(F.col("extension") == ".csv")
    if skip_existing:
        landed = listing.where(F.col("extension") == ".parquet").select("year", "stem")
        src = src.join(landed, ["year", "stem"], "left_anti")
    paths = [r["path"] for r in src.select("path").collect()]  # one row per file: metadata only
    found = heads.read_heads(spark, [(p, ".csv") for p in paths], multiline)
    broken = [h for h in found.values() if h.error]
    if broken:
        raise OSError("; ".join(f"{h.path}: {h.error}" for h in broken))
    written = []
    for (_, names), group in heads.groups_of(found.values()).items():
        written += _land_group(spark, list(names), group, multiline)
    return sorted(written)


def unique_names(names: Sequence[str]) -> list[str]:
    """Header names kept verbatim, but Parquet cannot hold duplicates: repeated ones (whatever their case) get a
    positional suffix (the header plan drops them anyway)."""
    seen: dict = {}
    out = []
    for n in names:
        k = n.lower()
        seen[k] = seen.get(k, 0) + 1
        out.append(n if seen[k] == 1 else f"{n}.{seen[k] - 1}")
    return out


def _land_group(spark: SparkSession, names: list[str], group: Sequence[heads.Head], multiline: bool) -> list[str]:
    raw = scan_text_csv(spark, [h.path for h in group], tokens=None, positional=True, names=names, multiline=multiline)
    places = heads.part_places(spark, group)
    parts = heads.staged_rows(spark, [(f, *at) for f, at in places.items()], "_fp string, _n int, _part int", "files")
    out, file, split = unique_names(names), "__landed_file", "__landed_split"
    rows = raw.select("*", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_b"),
                      F.monotonically_increasing_id().alias("_m"))
    rows = rows.join(parts, "_fp")
    rows = rows.withColumn("_s", F.format_string("%08d-%018d", "_part", "_b")).sortWithinPartitions("_n", "_s", "_m")
    rows = rows.select(*[F.col(c) for c in raw.columns], "_n", "_s").toDF(*out, file, split)
    # beside the year folders: renames must stay in one file system
    first = group[0].path.rstrip("/")
    temp = f"{first.rsplit('/', 2)[0]}/_landing-{uuid.uuid4().hex[:12]}"
    rows.write.partitionBy(file, split).parquet(temp)
    targets = []
    for n, h in enumerate(group):
        target = h.path.rstrip("/")[: -len(".csv")] + ".parquet"
        ready = f"{temp}/ready-{n}"
        splits = sorted(p for p, is_dir, _, _ in _glob(spark, f"{temp}/{file}={n}/{split}=*") if is_dir)
        if not splits:  # a header without rows
            spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in out])).write.parquet(ready)
        else:
            _make_dir(spark, ready)
        k = 0
        for folder in splits:
            for p, _, _, _ in sorted(_glob(spark, f"{folder}/part-*")):
                _rename(spark, p, f"{ready}/part-{k:08d}-{uuid.uuid4().hex[:8]}.parquet")
                k += 1
        _delete(spark, target)
        _rename(spark, ready, target)
        targets.append(target)
    _delete(spark, temp)
    return targets


def _path_and_fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _make_dir(spark: SparkSession, path: str) -> None:
    p, fs = _path_and_fs(spark, path)
    fs.mkdirs(p)


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _path_and_fs(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    p, fs = _path_and_fs(spark, source)
    if not fs.rename(p, _path_and_fs(spark, target)[0]):
        raise OSError(f"can't rename {source} to {target}")
