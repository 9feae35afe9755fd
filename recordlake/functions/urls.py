"""Discovery expressions over links and file names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.config import discovery
from recordlake.functions._col import as_col
from recordlake.functions.text import ustrip


def filter_extension(href, extensions=discovery.VALID_EXTENSIONS) -> Column:
    """Lower-cased link ends with a spreadsheet extension (a query string defeats it)."""
    low = F.lower(as_col(href))
    cond = None
    for ext in extensions:
        e = low.endswith(ext)
        cond = e if cond is None else (cond | e)
    return cond


def filename_of(href) -> Column:
    """Text after the last ``/``."""
    return F.element_at(F.split(as_col(href), "/", -1), -1)


def classify_program(filename, context=None, keywords=discovery.PROGRAM_KEYWORDS) -> Column:
    """First keyword (in list order) contained in lower(filename + ' ' + context)."""
    ctx = F.lit("") if context is None else F.coalesce(as_col(context), F.lit(""))
    combined = F.lower(F.concat(F.coalesce(as_col(filename), F.lit("")), F.lit(" "), ctx))
    expr = None
    for kw, program in keywords:
        cond = combined.contains(kw)
        expr = F.when(cond, F.lit(program)) if expr is None else expr.when(cond, F.lit(program))
    return expr


def skip_deprecated(filename, context=None, patterns=discovery.SKIP_PATTERNS) -> Column:
    """True for deprecated annual reports; record layouts are never skipped."""
    ctx = F.lit("") if context is None else F.coalesce(as_col(context), F.lit(""))
    fname = F.coalesce(as_col(filename), F.lit(""))
    combined = F.lower(F.concat(fname, F.lit(" "), ctx))
    exempt = None
    for m in discovery.RECORD_LAYOUT_MARKERS:
        e = combined.contains(m)
        exempt = e if exempt is None else (exempt | e)
    hit = None
    for p in patterns:
        e = combined.contains(p)
        hit = e if hit is None else (hit | e)
    annual_pdf = combined.contains("annual") & combined.contains("report") & F.lower(fname).endswith(".pdf")
    return F.when(exempt, F.lit(False)).when(hit | annual_pdf, F.lit(True)).otherwise(F.lit(False))


def extract_year(filename) -> Column:
    """``fy`` + 2-4 digits (2 digits -> 20xx), else first 19xx/20xx, else ``unknown_year``."""
    f = as_col(filename)
    fy = F.regexp_extract(f, r"(?i)fy\s*(\d{2,4})", 1)
    plain = F.regexp_extract(f, r"(19|20)\d{2}", 0)
    return (F.when(F.length(fy) == 2, F.concat(F.lit("20"), fy))
            .when(F.length(fy) > 2, fy)
            .when(F.length(plain) > 0, plain)
            .otherwise(F.lit("unknown_year")))


# RFC 3986 appendix B split: scheme, authority, path, query, fragment.
_URL_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _split_url(u):
    parts = [F.regexp_extract(u, _URL_PARTS, i) for i in range(1, 6)]
    has_auth = u.rlike(r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//")
    return parts, has_auth


def normalize_url(url) -> Column:
    """Strip; lower scheme and authority; drop trailing ``/`` of the path; keep
    the query; drop the fragment. Tabs and newlines inside are removed first."""
    u = F.regexp_replace(ustrip(as_col(url)), r"[\t\r\n]", "")
    (scheme, auth, path, query, _frag), has_auth = _split_url(u)
    return F.concat(
        F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(F.lit("")),
        F.when(auth != "", F.concat(F.lit("//"), F.lower(auth))).otherwise(F.lit("")),
        F.regexp_replace(path, "/+$", ""),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
    )


def _remove_dot_segments(path: Column) -> Column:
    """RFC 3986 section 5.2.4 on an absolute path, as one array fold."""
    segs = F.slice(F.split(path, "/", -1), 2, 1 << 30)  # drop the empty head of "/..."
    folded = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    last = F.element_at(segs, -1)
    trailing = F.when(((last == ".") | (last == "..")) & (F.size(folded) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(folded, "/"), trailing)


def resolve_url(base, href) -> Column:
    """Resolve ``href`` against ``base`` (absolute, ``//host``, ``/root``,
    ``?query``, ``#fragment`` and relative paths with dot segments)."""
    b = as_col(base)
    h = as_col(href)
    (bs, ba, bp, bq, _bf), _ = _split_url(b)
    base_prefix = F.concat(F.when(bs != "", F.concat(bs, F.lit(":"))).otherwise(F.lit("")),
                           F.when(ba != "", F.concat(F.lit("//"), ba)).otherwise(F.lit("")))
    base_no_frag = F.concat(base_prefix, bp, F.when(bq != "", F.concat(F.lit("?"), bq)).otherwise(F.lit("")))
    (hs, ha, hp, hq, hf), _ = _split_url(h)
    tail = F.concat(F.when(hq != "", F.concat(F.lit("?"), hq)).otherwise(F.lit("")),
                    F.when(hf != "", F.concat(F.lit("#"), hf)).otherwise(F.lit("")))
    merged_dir = F.when((ba != "") & (bp == ""), F.lit("/")).otherwise(F.regexp_extract(bp, r"^(.*/)", 1))
    return (
        F.when(hs != "", h)
        .when(h.startswith("//"), F.concat(bs, F.lit(":"), h))
        .when(h == "", b)
        .when(h.startswith("#"), F.concat(base_no_frag, h))
        .when(h.startswith("?"), F.concat(base_prefix, bp, h))
        .when(h.startswith("/"), F.concat(base_prefix, _remove_dot_segments(hp), tail))
        .otherwise(F.concat(base_prefix, _remove_dot_segments(F.concat(merged_dir, hp)), tail))
    )
