"""Change detection and manifests (M1-M11), all set-based.

The source decides per URL with one query (or one dict lookup) per file. Here a
refresh run is a table of observations joined once to the manifest; the new
manifest is written as a new version directory, never over the one being read.
Joins against the manifest are left to Spark's size-based strategy (the
manifest grows with the number of files, so it is not forced to broadcast).
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.config import discovery as D
from recordlake.functions.paths import local_path
from recordlake.operators.ranking import ranked
from recordlake.session import staging_path
from recordlake.sources.heads import read_head, sub_folders

# --------------------------------------------------------------- schemas

MANIFEST_V1_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "url", "program", "year", "filename", "saved_path", "sha256", "etag", "last_modified",
    "downloaded_at", "checked_at")])

OBSERVATION_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("program", T.StringType()),
    T.StructField("year", T.StringType()), T.StructField("filename", T.StringType()),
    T.StructField("fetch_ok", T.BooleanType()), T.StructField("etag", T.StringType()),
    T.StructField("last_modified", T.StringType()), T.StructField("sha256", T.StringType()),
])

VERSIONED_SCHEMA = T.StructType([
    T.StructField("source_id", T.StringType(), False),
    T.StructField("file_type", T.StringType(), False),
    T.StructField("program", T.StringType()),
    T.StructField("period", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("saved_path", T.StringType(), False),
    T.StructField("bytes", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("last_modified", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("downloaded_at", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

SUMMARY_SCHEMA = T.StructType([
    T.StructField("lca", T.BooleanType()), T.StructField("perm", T.BooleanType()),
    T.StructField("pw", T.BooleanType()), T.StructField("scrape_time", T.StringType()),
    T.StructField("files_downloaded", T.LongType()), T.StructField("files_failed", T.LongType()),
])


def utc_now_iso() -> str:
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


# ------------------------------------------------------------ M1 / M11

def content_fingerprint(files: DataFrame, content_col: str = "content") -> DataFrame:
    """M1: SHA-256 hex and byte length of file content (e.g. a ``binaryFile`` scan),
    computed in the executors."""
    return files.withColumn("sha256", F.sha2(F.col(content_col), 256)) \
                .withColumn("bytes", F.length(F.col(content_col)).cast("long"))


def scan_fingerprints(spark: SparkSession, path_glob: str, name: str | None = None,
                      folders: int | None = None) -> DataFrame:
    """M1 over stored files: path, bytes, sha256 (``binaryFile`` source). With ``name``, a pattern of file
    names, those below the folder ``path_glob``: many folders are listed by Spark's tasks then, whereas a
    glob is followed by the driver folder by folder. The driver holds about 1 KB for each file that it has listed;
    with ``folders``, a folder that has more sub-folders is worked through in parts of as many, and the digests go
    to the shared folder."""
    reader = spark.read.format("binaryFile")
    # Spark counts a small file as 4 MB and so makes a task of a few; a task reads as many as leave a few tasks a core
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if name is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", name)

    def scanned(paths):
        return content_fingerprint(reader.load(paths)).select("path", "bytes", "sha256").coalesce(tasks)

    found = sub_folders(spark, path_glob) if name is not None and folders else []
    if not folders or len(found) <= folders:
        return scanned(path_glob)
    target, parts = staging_path(spark, "scan"), -(-len(found) // folders)
    for k in range(parts):
        scanned([re.sub(r"([\[\]{}*?\\])", r"\\\1", f) for f in found[k::parts]]).write.mode("append").parquet(target)
    return spark.read.schema("path string, bytes long, sha256 string").parquet(target)


def verify_fingerprints(manifest: DataFrame, stored: DataFrame, path_col: str = "saved_path") -> DataFrame:
    """Manifest rows whose stored file is missing or hashes differently."""
    m = manifest.withColumn("_local", local_path(F.col(path_col)))
    s = stored.select(local_path(F.col("path")).alias("_local"), F.col("sha256").alias("stored_sha256"))
    j = m.join(s, "_local", "left")
    return (j.where(F.col("stored_sha256").isNull() | (F.col("stored_sha256") != F.col("sha256")))
            .drop("_local"))


# ------------------------------------------------------------ M2 / M3

def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def change_status(observations: DataFrame, manifest: DataFrame) -> DataFrame:
    """M2: per observed file, the first matching tier:
    known + equal ETag -> skipped_etag; known + equal Last-Modified ->
    skipped_lastmod; fetch error -> failed; known + equal SHA-256 ->
    skipped_hash; else downloaded. Empty or absent header values never match.
    """
    m = manifest.select(F.col("url"), F.lit(True).alias("_known"),
                        F.col("etag").alias("_m_etag"), F.col("last_modified").alias("_m_lastmod"),
                        F.col("sha256").alias("_m_sha256"))
    j = observations.join(m, "url", "left")
    known = F.coalesce(F.col("_known"), F.lit(False))
    status = (F.when(known & _nonempty(F.col("etag")) & (F.col("etag") == F.col("_m_etag")), "skipped_etag")
              .when(known & _nonempty(F.col("last_modified")) & (F.col("last_modified") == F.col("_m_lastmod")),
                    "skipped_lastmod")
              .when(~F.coalesce(F.col("fetch_ok"), F.lit(False)), "failed")
              .when(known & (F.col("sha256") == F.col("_m_sha256")), "skipped_hash")
              .otherwise("downloaded"))
    return (j.withColumn("status", status)
            .withColumn("is_new", F.col("status") == "downloaded")
            .drop("_known", "_m_etag", "_m_lastmod", "_m_sha256"))


def last_observations(observations: DataFrame) -> DataFrame:
    """One row per url: the one with the largest ``observed_at`` (rows without it come first; ties
    go to the largest row), so that a file seen twice is one fetch."""
    cols = observations.columns
    when = [F.col("observed_at")] if "observed_at" in cols else []
    row = F.struct(*when, *[F.col(c) for c in cols if c != "observed_at"])
    last = observations.groupBy("url").agg(F.max(row).alias("_o"))
    return last.select(*[F.col(f"_o.{c}").alias(c) for c in cols])


def manifest_upsert(manifest: DataFrame, statuses: DataFrame, run_time: str, data_root: str = "data") -> DataFrame:
    """M3: ``downloaded`` replaces the entry; ``skipped_hash`` refreshes etag,
    last_modified and checked_at only; other outcomes leave the entry.

    A full outer join on url; the result is the next manifest version. Statuses that
    hold a url more than once raise an error (see ``last_observations``).
    """
    s = statuses.where(F.col("status").isin("downloaded", "skipped_hash")).select(
        "url", F.col("status").alias("_st"), F.col("program").alias("_program"), F.col("year").alias("_year"),
        F.col("filename").alias("_filename"), F.col("sha256").alias("_sha256"),
        F.col("etag").alias("_etag"), F.col("last_modified").alias("_lastmod"))
    # one row per url; the aggregate is on the join's key, so it adds no shuffle
    rest = [c for c in s.columns if c != "url"]
    twice = F.raise_error(F.concat(F.lit("several statuses for "), "url"))
    s = s.groupBy("url").agg(F.count("*").alias("_n"), F.max(F.struct(*rest)).alias("_s"))
    s = s.select("url", F.when(F.col("_n") > 1, twice.cast("string")).otherwise(F.col("_s._st")).alias("_st"),
                 *[F.col(f"_s.{c}").alias(c) for c in rest if c != "_st"])
    j = manifest.join(s, "url", "full_outer")
    dl = F.col("_st") == "downloaded"
    hs = F.col("_st") == "skipped_hash"
    saved = F.concat_ws("/", F.lit(data_root), F.col("_program"), F.col("_year"), F.col("_filename"))
    now = F.lit(run_time)
    pick = lambda new, old: F.when(dl, new).otherwise(F.col(old))
    return j.select(
        "url",
        pick(F.col("_program"), "program").alias("program"),
        pick(F.col("_year"), "year").alias("year"),
        pick(F.col("_filename"), "filename").alias("filename"),
        pick(saved, "saved_path").alias("saved_path"),
        pick(F.col("_sha256"), "sha256").alias("sha256"),
        F.when(dl | hs, F.col("_etag")).otherwise(F.col("etag")).alias("etag"),
        F.when(dl | hs, F.col("_lastmod")).otherwise(F.col("last_modified")).alias("last_modified"),
        pick(now, "downloaded_at").alias("downloaded_at"),
        F.when(dl, F.lit(None).cast("string")).when(hs, now).otherwise(F.col("checked_at")).alias("checked_at"),
    )


# ------------------------------------------------------------ M4

def _version_dirs(spark: SparkSession, root: str, complete_only: bool = True) -> list[tuple[int, str]]:
    """Version directories ``root/version=N``, newest first; by default only
    committed ones (with ``_SUCCESS``)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version=") and name[8:].isdigit():
            if not complete_only or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append((int(name[8:]), st.getPath().toString()))
    return sorted(out, reverse=True)


def load_manifest(spark: SparkSession, root: str, schema: T.StructType = MANIFEST_V1_SCHEMA,
                  before: int | None = None) -> tuple[DataFrame, int]:
    """M4: newest complete version (below ``before``, if given), else the previous one, else an empty table.

    Returns (manifest, version number; 0 when there is no version). A version is checked by its files' footers
    alone: each must be readable, and their rows add up to the count that was written with the version. One that
    fails is skipped with a warning; if versions exist and none can be read, this raises. (Damage inside a file
    whose footer is fine shows when the manifest is used, as an error.)
    """
    found = [(v, p) for v, p in _version_dirs(spark, root) if before is None or v < before]
    for version, path in found:
        rows, head = _read_text(spark, f"{path}/{ROWS}"), read_head(spark, path, ".parquet")
        whole = (head.error is None and rows in (None, str(head.rows))) or rows == "0"
        if whole:
            return spark.read.schema(schema).parquet(path), version
        warnings.warn(f"manifest version {version} has an unreadable file", stacklevel=2)
    if found:
        raise RuntimeError(f"none of {len(found)} manifest versions under {root} can be read")
    return spark.createDataFrame([], schema), 0


def next_version(spark: SparkSession, root: str) -> int:
    """Number for a new version: after every existing folder, complete or not,
    so a retry never collides with what a failed run left behind."""
    found = _version_dirs(spark, root, complete_only=False)
    return (found[0][0] + 1) if found else 1


def save_manifest(df: DataFrame, root: str, version: int, replay: bool = False) -> str:
    """Write a new manifest version directory (never the one being read); with ``replay`` what an
    unfinished run left there is replaced."""
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("overwrite" if replay else "errorifexists").parquet(path)
    head = read_head(df.sparkSession, path, ".parquet")
    _write_text(df.sparkSession, f"{path}/{ROWS}", str(head.rows or 0))
    return path


#: File of a version folder with the number of its rows.
ROWS = "_rows"


def _read_text(spark: SparkSession, path: str) -> str | None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(draft, False)
    try:
        out.writeBytes(text)
    finally:
        out.close()
    if not fs.rename(draft, p):
        raise OSError(f"can't write {path}")


def epoch_entry(spark: SparkSession, root: str, stream: str, epoch: int, run_time: str) -> tuple[int, str]:
    """(version, run time) of a stream's epoch: those in the ledger ``root/_epochs/<stream>/<epoch>``, where
    an earlier run of this epoch has left them, else the next version and ``run_time``, entered now."""
    entry = f"{root.rstrip('/')}/_epochs/{stream}/{epoch}"
    found = _read_text(spark, entry)
    if found is not None:
        version, when = found.split(" ", 1)
        return int(version), when
    version = next_version(spark, root)
    _write_text(spark, entry, f"{version} {run_time}")
    return version, run_time


# ------------------------------------------------------------ M5-M9

def latest_active(table: DataFrame) -> DataFrame:
    """M5: per (period, url), the ``active`` row with the highest version.

    ``max_by`` aggregates partially before the shuffle, so one URL with many
    versions never gathers in a single task.
    """
    cols = table.columns
    return (table.where(F.col("status") == D.MANIFEST_ACTIVE)
            .groupBy("period", "url")
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("version")).alias("_r"))
            .select("_r.*"))


def plan_downloads(requests: DataFrame, table: DataFrame, mode: str = "safe",
                   stored: DataFrame | None = None) -> DataFrame:
    """M6: per requested (period, url): not in manifest -> download; fast mode
    -> skip; safe mode and the saved file is gone -> download; else skip.

    ``stored`` lists existing files (column ``path``), e.g. a ``binaryFile``
    scan without its content column; required in safe mode.
    """
    mode = mode.lower().strip()
    act = latest_active(table).select("period", "url", F.col("saved_path").alias("_saved"),
                                      F.lit(True).alias("_exists"))
    j = requests.join(act, ["period", "url"], "left")
    exists = F.coalesce(F.col("_exists"), F.lit(False))
    if mode == "fast":
        decision = F.when(exists, "skip").otherwise("download")
        reason = F.when(exists, D.PLAN_REASON_FAST).otherwise(D.PLAN_REASON_NEW)
        return j.select(*requests.columns, decision.alias("decision"), reason.alias("reason"))
    if stored is None:
        raise ValueError("safe mode needs the stored-file listing")
    files = stored.select(local_path(F.col("path")).alias("_local")).distinct().withColumn("_present", F.lit(True))
    j = j.withColumn("_local", local_path(F.col("_saved")))
    # requests without a saved file never match: keep them out of the join, where they would be one hot null key
    new = j.where(F.col("_local").isNull()).withColumn("_present", F.lit(False))
    j = j.where(F.col("_local").isNotNull()).join(files, "_local", "left").unionByName(new)
    present = F.coalesce(F.col("_present"), F.lit(False))
    decision = F.when(~exists, "download").when(~present, "download").otherwise("skip")
    reason = (F.when(~exists, D.PLAN_REASON_NEW).when(~present, D.PLAN_REASON_MISSING)
              .otherwise(D.PLAN_REASON_VERIFIED))
    return j.select(*requests.columns, decision.alias("decision"), reason.alias("reason"))


def record_versions(table: DataFrame, downloads: DataFrame, source_id: str, file_type: str,
                    program: str | None = None, now: Column | None = None) -> DataFrame:
    """M7, batch form: each download becomes a new ``active`` row whose version
    is the current active version + 1 (or 1), in download-time order; the
    previously active row of that (period, url) becomes ``replaced``.

    ``downloads``: period, url, filename, saved_path, bytes, sha256, etag,
    last_modified, downloaded_at. Returns the whole next table. Versions are counted
    in slices of a url's downloads (``ranked``), so one url may hold most of them.
    """
    now = now if now is not None else F.current_timestamp()
    base = (latest_active(table).select("period", "url", F.col("version").alias("_base")))
    new = ranked(downloads, ["period", "url"], ["downloaded_at", "saved_path"]).join(base, ["period", "url"], "left")
    new = new.withColumn("_last", F.col("_rank") == F.col("_size"))
    new_rows = new.select(
        F.lit(source_id).alias("source_id"), F.lit(file_type).alias("file_type"),
        F.lit(program).cast("string").alias("program"), "period", "url", "filename", "saved_path",
        F.col("bytes").cast("long").alias("bytes"), "sha256", "etag", "last_modified",
        (F.coalesce(F.col("_base"), F.lit(0)) + F.col("_rank")).cast("int").alias("version"),
        F.when(F.col("_last"), F.lit(D.MANIFEST_ACTIVE)).otherwise(F.lit(D.MANIFEST_REPLACED)).alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("downloaded_at").cast("timestamp").alias("downloaded_at"),
        F.col("downloaded_at").cast("timestamp").alias("created_at"),
        F.when(F.col("_last"), F.col("downloaded_at").cast("timestamp")).otherwise(now).alias("updated_at"))
    touched = downloads.select("period", "url").distinct().withColumn("_touched", F.lit(True))
    old = table.join(touched, ["period", "url"], "left")
    replace = F.coalesce(F.col("_touched"), F.lit(False)) & (F.col("status") == D.MANIFEST_ACTIVE)
    old_rows = old.select(*[
        (F.when(replace, F.lit(D.MANIFEST_REPLACED)).otherwise(F.col("status")).alias("status") if c == "status"
         else F.when(replace, now).otherwise(F.col("updated_at")).alias("updated_at") if c == "updated_at"
         else F.col(c)) for c in table.columns])
    return old_rows.unionByName(new_rows.select(*table.columns))


def record_failures(table: DataFrame, failures: DataFrame, source_id: str, file_type: str,
                    program: str | None = None, now: Column | None = None) -> DataFrame:
    """M8: append one ``failed`` row per failure (version 1, typed nulls); the
    active row is left as it is. ``failures``: period, url, filename, error."""
    now = now if now is not None else F.current_timestamp()
    rows = failures.select(
        F.lit(source_id).alias("source_id"), F.lit(file_type).alias("file_type"),
        F.lit(program).cast("string").alias("program"), "period", "url", "filename",
        F.lit("").alias("saved_path"), F.lit(None).cast("long").alias("bytes"),
        F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"), F.lit(1).alias("version"),
        F.lit(D.MANIFEST_FAILED).alias("status"), F.col("error").cast("string").alias("error_message"),
        F.lit(None).cast("timestamp").alias("downloaded_at"), now.alias("created_at"), now.alias("updated_at"))
    return table.unionByName(rows.select(*table.columns))


def create_manifest_table(spark: SparkSession, name: str, location: str | None = None,
                          database: str | None = None) -> None:
    """M9: create the schema (``database``, optional) and the 17-column
    versioned manifest table if they do not exist (Parquet; defaults honoured,
    NOT NULL documented but not enforced by the format: check with
    :func:`check_not_null` before writing)."""
    # FIXED VALUES: column names, types, NOT NULL and defaults
    loc = f" LOCATION '{location}'" if location else ""
    if database:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database}")
        name = f"{database}.{name}"
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
            source_id      STRING    NOT NULL COMMENT 'where the file comes from',
            file_type      STRING    NOT NULL COMMENT 'kind of publication: monthly, annual, performance or employer',
            program        STRING             COMMENT 'full program name, null if it has none',
            period         STRING    NOT NULL COMMENT 'time span (and program) that the file covers',
            url            STRING    NOT NULL COMMENT 'address the file was fetched from',
            filename       STRING    NOT NULL COMMENT 'last part of the address',
            saved_path     STRING    NOT NULL COMMENT 'where the file is kept',
            bytes          BIGINT             COMMENT 'length of the kept file',
            sha256         STRING             COMMENT 'hex digest of the kept file',
            etag           STRING             COMMENT 'ETag of the answer, if any',
            last_modified  STRING             COMMENT 'Last-Modified of the answer, if any',
            version        INT       DEFAULT 1 COMMENT 'counts the contents seen at this address',
            status         STRING    DEFAULT 'active' COMMENT 'active, replaced, missing or failed',
            error_message  STRING             COMMENT 'why a fetch failed',
            downloaded_at  TIMESTAMP          COMMENT 'when this content was fetched',
            created_at     TIMESTAMP DEFAULT current_timestamp() COMMENT 'when the row was made',
            updated_at     TIMESTAMP DEFAULT current_timestamp() COMMENT 'when the row last changed'
        ) USING parquet{loc}
        COMMENT 'one row per content version of each fetched file'
    """)


def check_not_null(df: DataFrame, schema: T.StructType = VERSIONED_SCHEMA) -> DataFrame:
    """Fail the write if a NOT NULL column of ``schema`` holds a null."""
    required = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    if not required:
        return df
    bad = F.greatest(*[F.col(c).isNull().cast("int") for c in required]) if len(required) > 1 \
        else F.col(required[0]).isNull().cast("int")
    # a filter is always evaluated (a projected-then-dropped check would be pruned)
    return df.where(F.when(bad == 1, F.raise_error(F.lit("NOT NULL column is null")).cast("boolean"))
                    .otherwise(F.lit(True)))


def save_versions(table: DataFrame, root: str) -> tuple[str, int]:
    """Write the next versioned-manifest table (M7/M8 output) as a new version
    folder, after the NOT NULL check. Returns (path, version)."""
    spark = table.sparkSession
    v = next_version(spark, root)
    return save_manifest(check_not_null(table), root, v), v


# ------------------------------------------------------------ M10

def run_summary(statuses: DataFrame, scrape_time: str) -> DataFrame:
    """One row: per-program new-data flags, run time, downloaded and failed counts."""
    flags = [F.coalesce(F.max((F.col("program") == full) & F.col("is_new")), F.lit(False)).alias(short)
             for full, short in D.PROGRAM_KEYS]
    return statuses.agg(*flags,
                        F.lit(scrape_time).alias("scrape_time"),
                        F.count_if(F.col("status") == "downloaded").cast("long").alias("files_downloaded"),
                        F.count_if(F.col("status") == "failed").cast("long").alias("files_failed"))
