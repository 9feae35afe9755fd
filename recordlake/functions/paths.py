"""Storage layout expressions (L1-L4)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.functions._col import as_col
from recordlake.functions.text import ustrip


def strip_uri_prefix(path, scheme: str = "dbfs") -> Column:
    """L1: ``<scheme>:/x`` -> ``/<scheme>/x``; other paths unchanged."""
    return F.regexp_replace(as_col(path), rf"^{scheme}:/", f"/{scheme}/")


def local_path(path, scheme: str = "dbfs") -> Column:
    """One spelling for a stored file: L1, and ``file:`` paths without their scheme."""
    return strip_uri_prefix(F.regexp_replace(as_col(path), r"^file:(//)?(?=/)", ""), scheme)


def sanitize_name(name, max_len: int = 80) -> Column:
    r"""L2: strip, each of ``\ / * ? : " < > |`` -> ``_``, first ``max_len`` characters."""
    return F.substring(F.regexp_replace(ustrip(as_col(name)), r'[\\/*?:"<>|]', "_"), 1, max_len)


def monthly_path(root, program, period) -> Column:
    """L3: ``{root}/monthly/{program}/{FYdddd}/{period}``; no FY level when the period lacks one."""
    fy = F.regexp_extract(as_col(period), r"^(FY\d{4})", 1)
    head = F.concat_ws("/", as_col(root), F.lit("monthly"), as_col(program))
    return F.when(fy != "", F.concat_ws("/", head, fy, as_col(period))).otherwise(F.concat_ws("/", head, as_col(period)))


def annual_path(root, year) -> Column:
    """``{root}/annual/{year}``."""
    return F.concat_ws("/", as_col(root), F.lit("annual"), as_col(year))


def program_year_path(root, program, year) -> Column:
    """``{root}/{sanitize(program)}/{year}``."""
    return F.concat_ws("/", as_col(root), sanitize_name(program), as_col(year))


def visa_year_path(root, visa_type, year) -> Column:
    """``{root}/{visa_type}/{year}``."""
    return F.concat_ws("/", as_col(root), as_col(visa_type), as_col(year))
