"""Discovery constants.

FIXED VALUES: file extensions, program keywords (checked in this order, as
substrings), program short keys, and the deprecated-report skip patterns.
"""

VALID_EXTENSIONS = (".xlsx", ".xls", ".csv")

PROGRAM_KEYWORDS = (
    ("lca", "LCA Program"),
    ("h-1b", "LCA Program"),
    ("h1b", "LCA Program"),
    ("perm", "PERM Program"),
    ("pw", "Prevailing Wage Program"),
    ("prevailing", "Prevailing Wage Program"),
)

PROGRAM_KEYS = (
    ("LCA Program", "lca"),
    ("PERM Program", "perm"),
    ("Prevailing Wage Program", "pw"),
)

SKIP_PATTERNS = (
    "annual performance report",
    "fy 2016 report", "fy 2015 report", "fy 2014 report", "fy 2013 report",
    "fy 2012 report", "fy 2011 report", "fy 2010 report", "fy 2009 report",
    "fy 2007 report", "fy 2006 report",
)

# Exemption checked before the skip patterns.
RECORD_LAYOUT_MARKERS = ("record layout", "record_layout")

# Elements whose text gives a link its program: enclosing blocks, then headings.
CONTEXT_BLOCK_TAGS = ("td", "li", "p", "div")
HEADING_TAGS = ("h2", "h3", "h4", "strong", "b")

# Fetch outcomes of one refresh run.
OUTCOME_STATUSES = ("downloaded", "skipped_etag", "skipped_lastmod", "skipped_hash", "failed")

# Versioned manifest: row states and download-plan reasons.
MANIFEST_ACTIVE = "active"
MANIFEST_REPLACED = "replaced"
MANIFEST_FAILED = "failed"
PLAN_REASON_NEW = "not in manifest"
PLAN_REASON_FAST = "exists (fast mode)"
PLAN_REASON_MISSING = "file missing from DBFS"
PLAN_REASON_VERIFIED = "exists and verified on DBFS"
