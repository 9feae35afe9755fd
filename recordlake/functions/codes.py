"""Code maps (C2-C5): one single-pass lookup with pass-through of unknown values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.config import codes
from recordlake.functions._col import as_col
from recordlake.functions.text import ustrip


def recode(c, mapping: dict, nulls=()) -> Column:
    """Replace values by ``mapping`` in one pass; ``nulls`` become null; others pass.

    Built as one CASE expression (keys grouped per output), so it stays inside
    whole-stage codegen and needs no join.
    """
    c = as_col(c)
    by_out: dict = {}
    for k, v in mapping.items():
        by_out.setdefault(v, []).append(k)
    expr = None
    if nulls:
        expr = F.when(c.isin(*nulls), F.lit(None).cast("string"))
    for out, keys in by_out.items():
        cond = c.isin(*keys)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return c if expr is None else expr.otherwise(c)


def standardize_status(c, variant: str = "lca") -> Column:
    """Strip, upper, map case status; unknown values stay upper-cased."""
    mapping = codes.STATUS_MAP_LCA if variant == "lca" else codes.STATUS_MAP_PERM
    return recode(F.upper(ustrip(as_col(c).cast("string"))), mapping, codes.STATUS_NULLS)


def standardize_visa_class(c) -> Column:
    """Strip (case kept), map one-letter visa codes."""
    return recode(ustrip(as_col(c).cast("string")), codes.VISA_CLASS_MAP, codes.VISA_CLASS_NULLS)


def standardize_pay_unit(c) -> Column:
    """C4: strip, exact-case pay unit map (``Yr`` passes unchanged)."""
    return recode(ustrip(as_col(c).cast("string")), codes.PAY_UNIT_MAP, codes.PAY_UNIT_NULLS)


def standardize_yes_no(c) -> Column:
    """Strip, map yes/no spellings and 0/1 codes."""
    return recode(ustrip(as_col(c).cast("string")), codes.YES_NO_MAP, codes.YES_NO_NULLS)
