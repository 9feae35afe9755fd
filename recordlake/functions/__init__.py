"""Column -> Column building blocks (all JVM-side built-in expressions)."""

from recordlake.functions.text import ustrip, null_tokens, clean_text, clean_upper_text, html_text
from recordlake.functions.codes import (
    recode, standardize_status, standardize_visa_class, standardize_pay_unit, standardize_yes_no,
)
from recordlake.functions.casts import coerce_double, coerce_long, coerce_timestamp
from recordlake.functions.urls import (
    filter_extension, filename_of, classify_program, skip_deprecated, extract_year,
    normalize_url, resolve_url,
)
from recordlake.functions.paths import (
    strip_uri_prefix, sanitize_name, monthly_path, annual_path, program_year_path, visa_year_path,
)

__all__ = [
    "ustrip", "null_tokens", "clean_text", "clean_upper_text", "html_text",
    "recode", "standardize_status", "standardize_visa_class", "standardize_pay_unit", "standardize_yes_no",
    "coerce_double", "coerce_long", "coerce_timestamp",
    "filter_extension", "filename_of", "classify_program", "skip_deprecated", "extract_year",
    "normalize_url", "resolve_url",
    "strip_uri_prefix", "sanitize_name", "monthly_path", "annual_path", "program_year_path", "visa_year_path",
]
