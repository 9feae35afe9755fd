"""Change-detection and manifest checks (M1-M11) on ``pages`` and ``events``."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from recordlake.functions import normalize_url
from recordlake.operators.dedupe import dedupe_keep_first
from recordlake.operators.manifest import (
    MANIFEST_V1_SCHEMA, change_status, content_fingerprint, create_manifest_table, latest_active, load_manifest,
    manifest_upsert, plan_downloads, record_failures, record_versions, run_summary, save_manifest,
    scan_fingerprints, verify_fingerprints,
)
from recordlake.session import local_folder, staging_path, written
from recordlake.sources.sinks import write_local_files
from recordlake.workloads import _sql as S
from recordlake.workloads._tables import table
from recordlake.workloads.dedupe import sql_normalize_url

RUN_TIME = "2026-01-01T00:00:00+00:00"
PROGRAMS = ["LCA Program", "PERM Program", "Prevailing Wage Program"]


# ---- M1 / M11

def q_content_fingerprint(spark, d):
    p = table(spark, d, "pages")
    f = content_fingerprint(p.select("page_id", F.col("html").cast("binary").alias("content")))
    return f.select("page_id", "sha256", "bytes")


SQL_FINGERPRINT = "SELECT page_id, sha256(html) AS sha256, CAST(strlen(html) AS BIGINT) AS bytes FROM pages"


def q_verify_fingerprints(spark, d):
    p = table(spark, d, "pages")
    digest = F.sha2(F.col("html").cast("binary"), 256)
    manifest = p.select("page_id", F.concat(F.lit("dbfs:/data/pages/"), F.col("page_id").cast("string")).alias("saved_path"),
                        F.when(F.col("page_id") % 6 == 0, F.lit("stale")).otherwise(digest).alias("sha256"))
    stored = p.where(F.col("page_id") % 10 != 3).select(
        F.concat(F.lit("file:/dbfs/data/pages/"), F.col("page_id").cast("string")).alias("path"), digest.alias("sha256"))
    return verify_fingerprints(manifest, stored).select("page_id", "saved_path", "sha256", "stored_sha256")


SQL_VERIFY = """
SELECT page_id, 'dbfs:/data/pages/' || page_id AS saved_path,
       CASE WHEN page_id % 6 = 0 THEN 'stale' ELSE sha256(html) END AS sha256,
       CASE WHEN page_id % 10 = 3 THEN NULL ELSE sha256(html) END AS stored_sha256
FROM pages WHERE page_id % 10 = 3 OR page_id % 6 = 0
"""


#: Stored pages in a folder, about, and folders that are listed at once (half as many are still listed by tasks).
PAGES_A_FOLDER, FOLDERS_AT_ONCE = 500, 72


def _stored_pages(spark, d):
    """Every page kept as a file of its own. A file takes its time whatever its size, so the tasks that make
    them are as many as keep all cores busy, however few splits the pages have. Each makes a folder; so many that
    Spark's tasks list them."""
    root = staging_path(spark, "stored")
    pages = table(spark, d, "pages").select("page_id", F.col("html").alias("value"))
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")),
                1 + int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold")),
                -(-pages.count() // PAGES_A_FOLDER))
    p = pages.repartition(tasks, "page_id")
    folder = local_folder(spark, root)
    if folder is None:
        p.withColumn("part", F.pmod(F.hash("page_id"), F.lit(tasks))).write.partitionBy("part", "page_id").text(root)
        return scan_fingerprints(spark, root, name="part-*", folders=FOLDERS_AT_ONCE)
    name = F.concat(F.lit("page_id="), F.coalesce(F.col("page_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    line = F.concat(F.coalesce(F.col("value"), F.lit("")).cast("binary"), F.lit("\n").cast("binary"))
    write_local_files(p.select(name.alias("name"), line.alias("content")), folder)
    return scan_fingerprints(spark, root, name="page_id=*", folders=FOLDERS_AT_ONCE)


def _page_of(path):
    return F.regexp_extract(path, r"page_id=(\d+)", 1).cast("long")


def q_stored_file_fingerprints(spark, d):
    """M1 over stored files."""
    return _stored_pages(spark, d).select(_page_of("path").alias("page_id"), "bytes", "sha256")


SQL_STORED = """
SELECT page_id, CAST(strlen(html) + 1 AS BIGINT) AS bytes, sha256(html || chr(10)) AS sha256 FROM pages
"""


def q_verify_stored_files(spark, d):
    """M11 over stored files: entries with another digest, and entries whose file is gone."""
    stored = written(_stored_pages(spark, d), "fingerprints")
    page = _page_of("path")
    manifest = stored.select(page.alias("page_id"),
                             F.when(page % 10 == 3, F.concat("path", F.lit(".gone"))).otherwise(F.col("path")).alias("saved_path"),
                             F.when(page % 6 == 0, F.lit("stale")).otherwise(F.col("sha256")).alias("sha256"))
    return verify_fingerprints(manifest, stored).select("page_id", "sha256", "stored_sha256")


SQL_VERIFY_STORED = """
SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 'stale' ELSE sha256(html || chr(10)) END AS sha256,
       CASE WHEN page_id % 10 = 3 THEN NULL ELSE sha256(html || chr(10)) END AS stored_sha256
FROM pages WHERE page_id % 10 = 3 OR page_id % 6 = 0
"""


# ---- M2 / M3 / M10

def _observations_and_manifest(spark, d):
    p = table(spark, d, "pages")
    pid = F.col("page_id")
    base = p.select("page_id", normalize_url(F.col("url")).alias("url"), F.sha2(F.col("html").cast("binary"), 256).alias("h"))
    base = dedupe_keep_first(base, "url", [pid])
    prog = F.element_at(F.array(*[F.lit(x) for x in PROGRAMS]), (pid % 3 + 1).cast("int"))
    obs = base.select(
        "url", prog.alias("program"), F.format_string("20%02d", pid % 25).alias("year"),
        F.concat(F.lit("f"), pid.cast("string"), F.lit(".xlsx")).alias("filename"),
        (pid % 11 != 0).alias("fetch_ok"),
        F.when(pid % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("e"), (pid % 5).cast("string"))).alias("etag"),
        F.concat(F.lit("lm"), (pid % 4).cast("string")).alias("last_modified"),
        F.col("h").alias("sha256"))
    m = pid % 5
    man = base.where(m != 0).select(
        "url", prog.alias("program"), F.lit("2020").alias("year"),
        F.concat(F.lit("f"), pid.cast("string"), F.lit(".xlsx")).alias("filename"),
        F.concat(F.lit("data/old/"), pid.cast("string")).alias("saved_path"),
        F.when(m == 3, F.col("h")).otherwise(F.lit("old-hash")).alias("sha256"),
        F.when(pid % 7 == 0, F.lit("")).when(m == 1, F.lit("e1")).otherwise(F.lit("old-etag")).alias("etag"),
        F.when(m == 2, F.concat(F.lit("lm"), (pid % 4).cast("string"))).otherwise(F.lit("old-lm")).alias("last_modified"),
        F.lit("2025-01-01T00:00:00+00:00").alias("downloaded_at"), F.lit(None).cast("string").alias("checked_at"))
    return obs, man


def q_change_status(spark, d):
    obs, man = _observations_and_manifest(spark, d)
    return change_status(obs, man).select("url", "program", "fetch_ok", "status", "is_new")


def _sql_base():
    prog = S.pick("page_id % 3", PROGRAMS)
    return f"""
    b0 AS (SELECT page_id, {sql_normalize_url('url')} AS url, sha256(html) AS h FROM pages),
    base AS (SELECT page_id, url, h FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) rn FROM b0) WHERE rn = 1),
    obs AS (SELECT url, {prog} AS program, printf('20%02d', page_id % 25) AS year, 'f' || page_id || '.xlsx' AS filename,
                   page_id % 11 <> 0 AS fetch_ok,
                   CASE WHEN page_id % 7 = 0 THEN '' ELSE 'e' || (page_id % 5) END AS etag,
                   'lm' || (page_id % 4) AS last_modified, h AS sha256 FROM base),
    man AS (SELECT url, {prog} AS program, '2020' AS year, 'f' || page_id || '.xlsx' AS filename,
                   'data/old/' || page_id AS saved_path,
                   CASE WHEN page_id % 5 = 3 THEN h ELSE 'old-hash' END AS sha256,
                   CASE WHEN page_id % 7 = 0 THEN '' WHEN page_id % 5 = 1 THEN 'e1' ELSE 'old-etag' END AS etag,
                   CASE WHEN page_id % 5 = 2 THEN 'lm' || (page_id % 4) ELSE 'old-lm' END AS last_modified,
                   '2025-01-01T00:00:00+00:00' AS downloaded_at, CAST(NULL AS VARCHAR) AS checked_at
            FROM base WHERE page_id % 5 <> 0),
    st AS (SELECT o.*,
             CASE WHEN m.url IS NOT NULL AND o.etag <> '' AND o.etag = m.etag THEN 'skipped_etag'
                  WHEN m.url IS NOT NULL AND o.last_modified <> '' AND o.last_modified = m.last_modified THEN 'skipped_lastmod'
                  WHEN NOT o.fetch_ok THEN 'failed'
                  WHEN m.url IS NOT NULL AND o.sha256 = m.sha256 THEN 'skipped_hash'
                  ELSE 'downloaded' END AS status
           FROM obs o LEFT JOIN man m ON o.url = m.url)"""


SQL_CHANGE_STATUS = f"""
WITH {_sql_base()}
SELECT url, program, fetch_ok, status, status = 'downloaded' AS is_new FROM st
"""


def q_manifest_upsert(spark, d):
    obs, man = _observations_and_manifest(spark, d)
    return manifest_upsert(man, change_status(obs, man), RUN_TIME)


SQL_UPSERT = f"""
WITH {_sql_base()},
s AS (SELECT * FROM st WHERE status IN ('downloaded', 'skipped_hash'))
SELECT COALESCE(m.url, s.url) AS url,
  CASE WHEN s.status = 'downloaded' THEN s.program ELSE m.program END AS program,
  CASE WHEN s.status = 'downloaded' THEN s.year ELSE m.year END AS year,
  CASE WHEN s.status = 'downloaded' THEN s.filename ELSE m.filename END AS filename,
  CASE WHEN s.status = 'downloaded' THEN 'data/' || s.program || '/' || s.year || '/' || s.filename ELSE m.saved_path END AS saved_path,
  CASE WHEN s.status = 'downloaded' THEN s.sha256 ELSE m.sha256 END AS sha256,
  CASE WHEN s.status IN ('downloaded', 'skipped_hash') THEN s.etag ELSE m.etag END AS etag,
  CASE WHEN s.status IN ('downloaded', 'skipped_hash') THEN s.last_modified ELSE m.last_modified END AS last_modified,
  CASE WHEN s.status = 'downloaded' THEN '{RUN_TIME}' ELSE m.downloaded_at END AS downloaded_at,
  CASE WHEN s.status = 'downloaded' THEN NULL WHEN s.status = 'skipped_hash' THEN '{RUN_TIME}' ELSE m.checked_at END AS checked_at
FROM man m FULL OUTER JOIN s ON m.url = s.url
"""


def q_run_summary(spark, d):
    obs, man = _observations_and_manifest(spark, d)
    return run_summary(change_status(obs, man), RUN_TIME)


SQL_SUMMARY = f"""
WITH {_sql_base()}
SELECT COALESCE(bool_or(program = 'LCA Program' AND status = 'downloaded'), false) AS lca,
       COALESCE(bool_or(program = 'PERM Program' AND status = 'downloaded'), false) AS perm,
       COALESCE(bool_or(program = 'Prevailing Wage Program' AND status = 'downloaded'), false) AS pw,
       '{RUN_TIME}' AS scrape_time,
       count(*) FILTER (WHERE status = 'downloaded') AS files_downloaded,
       count(*) FILTER (WHERE status = 'failed') AS files_failed
FROM st
"""


# ---- M5 / M7 / M8 / M6 on events as downloads of (period, url)

CUTOFF = "2024-01-20 00:00:00"
NOW = "2026-01-01 00:00:00"


def _downloads(spark, d):
    e = table(spark, d, "events")
    return e.select(
        F.concat(F.lit("P"), (F.col("user_id") % 10).cast("string")).alias("period"),
        F.concat(F.lit("https://files.example.org/f"), (F.col("event_id") % 7).cast("string"), F.lit(".xlsx")).alias("url"),
        F.concat(F.lit("f"), (F.col("event_id") % 7).cast("string"), F.lit(".xlsx")).alias("filename"),
        F.concat(F.lit("/data/"), F.col("event_id").cast("string")).alias("saved_path"),
        F.col("event_id").alias("bytes"), F.sha2(F.col("props").cast("binary"), 256).alias("sha256"),
        F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("last_modified"),
        F.col("ts").alias("downloaded_at"), F.col("value"), F.col("event_id"))


def _version_table(spark, d):
    dl = _downloads(spark, d)
    ok = dl.where(F.col("value") >= 2)
    cutoff = F.lit(CUTOFF).cast("timestamp")
    now = F.lit(NOW).cast("timestamp")
    # the table as it stood at the cutoff: versions in time order, last one active
    old = ok.where(F.col("downloaded_at") < cutoff)
    w = Window.partitionBy("period", "url").orderBy("downloaded_at")
    wl = Window.partitionBy("period", "url").orderBy(F.desc("downloaded_at"))
    existing = old.select(
        F.lit("records").alias("source_id"), F.lit("performance").alias("file_type"), F.lit(None).cast("string").alias("program"),
        "period", "url", "filename", "saved_path", F.col("bytes").cast("long").alias("bytes"), "sha256", "etag",
        "last_modified", F.row_number().over(w).cast("int").alias("version"),
        F.when(F.row_number().over(wl) == 1, F.lit("active")).otherwise(F.lit("replaced")).alias("status"),
        F.lit(None).cast("string").alias("error_message"), "downloaded_at",
        F.col("downloaded_at").alias("created_at"), F.col("downloaded_at").alias("updated_at"))
    new = ok.where(F.col("downloaded_at") >= cutoff).drop("value", "event_id")
    fails = dl.where((F.col("value") < 2) & (F.col("downloaded_at") >= cutoff)).select(
        "period", "url", "filename", F.concat(F.lit("timeout "), F.col("event_id").cast("string")).alias("error"))
    t = record_versions(existing, new, "records", "performance", now=now)
    return record_failures(t, fails, "records", "performance", now=now)


def q_record_versions(spark, d):
    return _version_table(spark, d).select("period", "url", "saved_path", "version", "status", "error_message",
                                           F.col("downloaded_at").cast("timestamp_ntz").alias("downloaded_at"))


def _sql_downloads():
    return """
    dl AS (SELECT 'P' || (user_id % 10) AS period, 'https://files.example.org/f' || (event_id % 7) || '.xlsx' AS url,
                  'f' || (event_id % 7) || '.xlsx' AS filename, '/data/' || event_id AS saved_path,
                  ts AS downloaded_at, value, event_id FROM events)"""


SQL_VERSIONS = f"""
WITH {_sql_downloads()},
ok AS (SELECT * FROM dl WHERE value >= 2),
v AS (SELECT period, url, saved_path,
             CAST(row_number() OVER (PARTITION BY period, url ORDER BY downloaded_at) AS INTEGER) AS version,
             CASE WHEN row_number() OVER (PARTITION BY period, url ORDER BY downloaded_at DESC) = 1 THEN 'active' ELSE 'replaced' END AS status,
             CAST(NULL AS VARCHAR) AS error_message, downloaded_at FROM ok)
SELECT * FROM v
UNION ALL
SELECT period, url, '' AS saved_path, 1 AS version, 'failed' AS status, 'timeout ' || event_id AS error_message,
       CAST(NULL AS TIMESTAMP) AS downloaded_at
FROM dl WHERE value < 2 AND downloaded_at >= TIMESTAMP '{CUTOFF}'
"""


def q_latest_active(spark, d):
    return latest_active(_version_table(spark, d)).select("period", "url", "version", "saved_path")


SQL_LATEST = f"""
WITH {_sql_downloads()},
ok AS (SELECT * FROM dl WHERE value >= 2)
SELECT period, url, CAST(count(*) AS INTEGER) AS version, arg_max(saved_path, downloaded_at) AS saved_path
FROM ok GROUP BY period, url
"""


def q_plan_downloads(spark, d):
    t = _version_table(spark, d)
    reqs = (_downloads(spark, d).select("period", "url").distinct()
            .unionByName(spark.range(3).select(F.lit("P99").alias("period"),
                                               F.concat(F.lit("https://files.example.org/new"), F.col("id").cast("string")).alias("url"))))
    stored = (_downloads(spark, d).where(F.col("event_id") % 4 != 0)
              .select(F.concat(F.lit("file:"), F.col("saved_path")).alias("path")))
    fast = plan_downloads(reqs, t, "fast").withColumn("mode", F.lit("fast"))
    safe = plan_downloads(reqs, t, "safe", stored=stored).withColumn("mode", F.lit("safe"))
    return fast.unionByName(safe)


SQL_PLAN = f"""
WITH {_sql_downloads()},
ok AS (SELECT * FROM dl WHERE value >= 2),
act AS (SELECT period, url, arg_max(saved_path, downloaded_at) AS saved_path, arg_max(event_id, downloaded_at) AS eid
        FROM ok GROUP BY period, url),
reqs AS (SELECT DISTINCT period, url FROM dl
         UNION ALL SELECT 'P99', 'https://files.example.org/new' || i FROM range(3) t(i)),
j AS (SELECT r.period, r.url, a.saved_path IS NOT NULL AS known, a.eid FROM reqs r LEFT JOIN act a USING (period, url))
SELECT period, url, CASE WHEN known THEN 'skip' ELSE 'download' END AS decision,
       CASE WHEN known THEN 'exists (fast mode)' ELSE 'not in manifest' END AS reason, 'fast' AS mode FROM j
UNION ALL
SELECT period, url,
       CASE WHEN NOT known THEN 'download' WHEN eid % 4 = 0 THEN 'download' ELSE 'skip' END,
       CASE WHEN NOT known THEN 'not in manifest' WHEN eid % 4 = 0 THEN 'file missing from DBFS'
            ELSE 'exists and verified on DBFS' END, 'safe' FROM j
"""


# ---- M4: newest complete manifest version, incomplete ones ignored

def q_load_manifest_with_backup(spark, d):
    root = staging_path(spark, "manifest")
    obs, _ = _observations_and_manifest(spark, d)
    v = obs.select("url", "program", "year", "filename", F.lit(None).cast("string").alias("saved_path"), "sha256",
                   "etag", "last_modified", F.lit(None).cast("string").alias("downloaded_at"),
                   F.lit(None).cast("string").alias("checked_at"))
    save_manifest(v.where(F.col("year") < "2012"), root, 1)
    save_manifest(v, root, 2)
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    prev = hconf.get(key)
    hconf.set(key, "false")  # a writer that never marked its version complete
    try:
        save_manifest(v, root, 3)
    finally:
        hconf.set(key, prev if prev is not None else "true")
    df, version = load_manifest(spark, root, MANIFEST_V1_SCHEMA)
    return df.select("url", "program", "year", "sha256", F.lit(version).alias("version"))


SQL_LOAD = f"""
WITH {_sql_base()}
SELECT url, program, year, sha256, 2 AS version FROM obs
"""


# ---- M9: table with defaults

def q_create_manifest_table(spark, d):
    name = f"manifest_{uuid.uuid4().hex[:10]}"
    create_manifest_table(spark, name, staging_path(spark, "table"))
    dl = _downloads(spark, d)
    dl.createOrReplaceTempView(f"{name}_src")
    spark.sql(f"""INSERT INTO {name} (source_id, file_type, program, period, url, filename, saved_path, bytes, sha256,
                  etag, last_modified, error_message, downloaded_at)
                  SELECT 'records', 'performance', NULL, period, url, filename, saved_path, bytes, sha256, etag,
                         last_modified, NULL, downloaded_at FROM {name}_src""")
    return spark.table(name).select("period", "url", "saved_path", "version", "status",
                                    F.col("created_at").isNotNull().alias("has_created_at"))


SQL_CREATE_TABLE = f"""
WITH {_sql_downloads()}
SELECT period, url, saved_path, 1 AS version, 'active' AS status, true AS has_created_at FROM dl
"""

QUERIES = {
    "content_fingerprint": q_content_fingerprint,
    "verify_fingerprints": q_verify_fingerprints,
    "stored_file_fingerprints": q_stored_file_fingerprints,
    "verify_stored_files": q_verify_stored_files,
    "change_status": q_change_status,
    "manifest_upsert": q_manifest_upsert,
    "run_summary": q_run_summary,
    "record_versions": q_record_versions,
    "latest_active": q_latest_active,
    "plan_downloads": q_plan_downloads,
    "load_manifest_with_backup": q_load_manifest_with_backup,
    "create_manifest_table": q_create_manifest_table,
}
ORACLE = {
    "content_fingerprint": SQL_FINGERPRINT,
    "verify_fingerprints": SQL_VERIFY,
    "stored_file_fingerprints": SQL_STORED,
    "verify_stored_files": SQL_VERIFY_STORED,
    "change_status": SQL_CHANGE_STATUS,
    "manifest_upsert": SQL_UPSERT,
    "run_summary": SQL_SUMMARY,
    "record_versions": SQL_VERSIONS,
    "latest_active": SQL_LATEST,
    "plan_downloads": SQL_PLAN,
    "load_manifest_with_backup": SQL_LOAD,
    "create_manifest_table": SQL_CREATE_TABLE,
}
