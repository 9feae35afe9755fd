"""Null tokens.

FIXED VALUES: the strings that pandas' CSV reader turns into missing values by
default (``pandas._libs.parsers.STR_NA_VALUES``, pandas 2.x). Every CSV hop of
the source workflow applies them, so harmonised text must apply them too.
"""

PANDAS_DEFAULT_NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Tokens that stringified nulls take after ``astype(str)`` and that the
# cleaning stage maps back to null (in addition to the empty string).
STRINGIFIED_NULL_TOKENS = ("nan", "NAN", "")
