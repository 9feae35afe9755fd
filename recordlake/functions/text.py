"""Text cleanup: Unicode-aware strip, null tokens, cleaned and upper-cased text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.config.nulls import PANDAS_DEFAULT_NA_TOKENS, STRINGIFIED_NULL_TOKENS
from recordlake.config.codes import UPPER_TEXT_NULLS
from recordlake.functions._col import as_col

# Python's str.strip() removes every character with isspace(): Java's Unicode
# \s covers all of them except the information separators U+001C..U+001F.
_WS = r"[\s\x{1c}-\x{1f}]"
_STRIP_PATTERN = rf"(?U)^{_WS}+|{_WS}+$"


def ustrip(c) -> Column:
    """Strip leading/trailing whitespace the way Python's ``str.strip`` does.

    ``F.trim`` removes spaces only; tabs and NBSP would survive it.
    """
    return F.regexp_replace(as_col(c), _STRIP_PATTERN, "")


_TOKEN_ARRAYS: dict = {}


def token_array(tokens) -> Column:
    """One array literal per token list and session, built once: applying a
    token test to hundreds of columns then costs no per-column literal setup."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    key = (tuple(tokens), spark.sparkContext.applicationId if spark else None)
    arr = _TOKEN_ARRAYS.get(key)
    if arr is None:
        arr = F.array(*[F.lit(t) for t in tokens]).cast("array<string>")
        _TOKEN_ARRAYS[key] = arr
    return arr


def null_tokens(c, tokens=PANDAS_DEFAULT_NA_TOKENS) -> Column:
    """C11: map reader-level null tokens (exact match, no strip) to null."""
    c = as_col(c)
    return F.when(F.array_contains(token_array(tokens), c), F.lit(None).cast("string")).otherwise(c)


def clean_text(c, tokens=STRINGIFIED_NULL_TOKENS) -> Column:
    """Strip, then the stringified-null tokens and the empty string become null."""
    s = ustrip(as_col(c).cast("string"))
    return F.when(s.isin(*tokens), F.lit(None).cast("string")).otherwise(s)


def clean_upper_text(c, tokens=UPPER_TEXT_NULLS) -> Column:
    """Strip, upper-case, then ``NAN`` and the empty string become null."""
    s = F.upper(ustrip(as_col(c).cast("string")))
    return F.when(s.isin(*tokens), F.lit(None).cast("string")).otherwise(s)


_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
             ("&#x27;", "'"), ("&amp;", "&"))


def unescape_entities(c) -> Column:
    """Decode the common named HTML entities (``&amp;`` last)."""
    out = as_col(c)
    for ent, ch in _ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def html_text(c) -> Column:
    """Text of an HTML fragment: every text node stripped, joined without separator."""
    parts = F.split(as_col(c), r"<[^>]*>")
    return unescape_entities(F.array_join(F.transform(parts, lambda p: ustrip(p)), ""))
