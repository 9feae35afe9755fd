"""Tolerant casts (C6-C8): text -> timestamp / double / long, bad values -> null.

Spark, pandas and DuckDB accept different number and date strings, so the
accepted shapes are spelled out here as patterns instead of left to a cast.
"""

import itertools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.functions._col import as_col

# Plain decimal or scientific notation, optional sign, surrounding whitespace.
# Rejects thousands separators, currency signs, ranges, hex, "12d"/"12f"
# suffixes, and "1_000", all of which some engine would otherwise accept.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?(inf|infinity)\s*$"

# Accepted formats; shapes that aren't listed become null. Single-letter fields accept
# one or two digits, no value has the shape of two formats. Two-digit years: see
# TWO_DIGIT_PIVOT. A value is handed only to the parser of its shape (failed parse
# attempts are expensive).
TIMESTAMP_FORMATS = (
    "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m:s.SSSSSSSSS", "yyyy-M-d", "yyyy/M/d H:m:s", "yyyy/M/d", "yyyyMMdd",
    "M/d/yyyy H:m:s", "M/d/yyyy H:m", "M/d/yyyy h:m:s a", "M/d/yyyy h:m a", "M/d/yyyy", "M/d/yy",
    "MMM d, yyyy", "MMMM d, yyyy", "d-MMM-yyyy", "d-MMM-yy",
)
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def shapes(fmt: str) -> list[str]:
    """All shapes of a format's values: 9 for a digit, A for a letter, other characters as they are."""
    kinds = {"yyyy": ["9999"], "yy": ["99"], "MM": ["99"], "dd": ["99"], "SSSSSSSSS": ["9" * n for n in range(1, 10)],
             "MMM": ["AAA"], "MMMM": ["A" * n for n in range(4, 10)], "a": ["AA"], "'T'": ["A"]}
    fields = re.findall(r"'T'|y+|M+|d+|H+|h+|m+|s+|S+|a|.", fmt)
    parts = [kinds.get(f, ["9", "99"] if f in "MdHhms" else [f]) for f in fields]
    return ["".join(p) for p in itertools.product(*parts)]


# Two-digit years from here on are 19yy, smaller ones 20yy.
TWO_DIGIT_PIVOT = 69

# Range of a nanosecond timestamp: values outside become null.
TIMESTAMP_MIN = "1677-09-21 00:12:44"
TIMESTAMP_MAX = "2262-04-11 23:47:16"


def _stripped(c) -> Column:
    return F.regexp_replace(as_col(c).cast("string"), r"^\s+|\s+$", "")


def coerce_double(c) -> Column:
    """Text -> double; malformed or overflowing values -> null, ``inf`` kept."""
    s = as_col(c).cast("string")
    is_inf_word = s.rlike(INFINITY_PATTERN)
    v = _stripped(s).try_cast("double")
    return (F.when(s.rlike(NUMBER_PATTERN), F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v))
            .when(is_inf_word, v))


def coerce_long(c, on_fraction: str = "raise") -> Column:
    """Text -> number -> nullable long.

    A fractional, infinite or out-of-range value is an error by default
    (``on_fraction="raise"``), as a nullable-integer cast would refuse it;
    ``on_fraction="null"`` maps it to null.
    Never truncates or rounds.
    """
    d = coerce_double(c)
    # fractions, infinities and values beyond the 64-bit range cannot become a long
    bad = d.isNotNull() & ((F.abs(d) >= 9.223372036854775807e18) | (d != F.floor(d)))
    if on_fraction == "raise":
        fail = F.raise_error(F.concat(F.lit("cannot cast a fractional or out-of-range value to an integer: "),
                                      as_col(c).cast("string")))
        return F.when(bad, fail.cast("long")).otherwise(d.cast("long"))
    if on_fraction == "null":
        return F.when(~bad, d.cast("long"))
    raise ValueError(f"on_fraction must be 'raise' or 'null', not {on_fraction!r}")


def coerce_timestamp(c, formats=TIMESTAMP_FORMATS) -> Column:
    """Text -> timestamp (without zone) by the format of the value's shape; failures and out-of-range -> null.

    The shape is made by one ``translate`` and looked up in each format's set of shapes, so no regular expression
    is matched and one parser runs at most.
    """
    s = _stripped(c)
    shape = F.translate(s, "0123456789" + _LETTERS, "9" * 10 + "A" * len(_LETTERS))

    # wall-clock (zone-less) result, like a naive parsed timestamp: parse in the
    # session zone and convert back, so the session zone never shifts values
    def parsed(fmt: str) -> Column:
        ts = F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")
        if "yy" not in fmt or "yyyy" in fmt:
            return ts
        return F.when(F.year(ts) >= 2000 + TWO_DIGIT_PIVOT, ts - F.expr("INTERVAL '100' YEAR")).otherwise(ts)
    ts = F.lit(None).cast("timestamp_ntz")
    for fmt in reversed(formats):
        ts = F.when(shape.isin(*shapes(fmt)), parsed(fmt)).otherwise(ts)
    in_range = ts.between(F.lit(TIMESTAMP_MIN).cast("timestamp_ntz"), F.lit(TIMESTAMP_MAX).cast("timestamp_ntz"))
    return F.when(in_range, ts)
