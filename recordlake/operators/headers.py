"""Header and schema harmonisation.

Headers drift from vintage to vintage: case, blanks, duplicates, renamed
fields, repeated site groups. All of that is resolved on the driver over the
column *names*; Spark then runs one positional ``select`` per vintage, so the
plan never depends on Spark's case-insensitive name resolution (two headers
``A`` and ``a`` would otherwise be ambiguous). Only H3 (all-null columns) looks
at data, with one aggregate pass.

A vintage's state is a list of :class:`Slot` = (physical position, current name).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.config import lca as lca_cfg
from recordlake.config import perm as perm_cfg
from recordlake.functions._col import as_col


@dataclass(frozen=True)
class Slot:
    index: int
    name: str


def slots_of(names: Sequence[str]) -> list[Slot]:
    return [Slot(i, n) for i, n in enumerate(names)]


def positional_names(n: int) -> list[str]:
    return [f"_p{i}" for i in range(n)]


# ---------------------------------------------------------------- name rules

def normalize_header(name: str) -> str:
    """H1: strip, lower, spaces and hyphens to ``_``; ``unnamed...`` -> ``""``."""
    s = str(name).strip().lower().replace(" ", "_").replace("-", "_")
    return "" if s.startswith("unnamed") else s


def normalize_headers(slots: list[Slot]) -> list[Slot]:
    return [Slot(s.index, normalize_header(s.name)) for s in slots]


def drop_duplicate_headers(slots: list[Slot]) -> list[Slot]:
    """H2: keep the first physical column of each name."""
    seen, out = set(), []
    for s in slots:
        if s.name not in seen:
            seen.add(s.name)
            out.append(s)
    return out


def drop_all_null_columns(slots: list[Slot], non_null_indices: Iterable[int]) -> list[Slot]:
    """H3: keep columns that hold at least one non-null value in this vintage."""
    keep = set(non_null_indices)
    return [s for s in slots if s.index in keep]


def drop_blank_headers(slots: list[Slot]) -> list[Slot]:
    """H4: drop columns whose (normalised) name is empty."""
    return [s for s in slots if s.name]


def is_repeat_group_column(name: str, prefixes=lca_cfg.REPEAT_GROUP_PREFIXES) -> bool:
    last = name.split("_")[-1]
    return last.isdigit() and int(last) >= 2 and any(name.startswith(p) for p in prefixes)


def drop_repeat_group_columns(slots: list[Slot], prefixes=lca_cfg.REPEAT_GROUP_PREFIXES) -> list[Slot]:
    """H5: drop site 2..n of repeated groups (``worksite_city_2`` ...); site 1 stays."""
    return [s for s in slots if not is_repeat_group_column(s.name, prefixes)]


def drop_second_site_columns(slots: list[Slot], prefixes=lca_cfg.SECOND_SITE_PREFIXES) -> list[Slot]:
    """H6: drop ``*_2`` columns of the dual-site layout."""
    return [s for s in slots if not (s.name.endswith("_2") and any(s.name.startswith(p) for p in prefixes))]


def alias_first_wins(slots: list[Slot], aliases: Mapping[str, str]) -> list[Slot]:
    """H7: rename every old name in the map (self-aliases ignored) in one
    simultaneous pass, then keep the first physical column of each name.

    A whole column wins, never a row-wise coalesce.
    """
    pairs = aliases.items() if isinstance(aliases, Mapping) else aliases
    present = {s.name for s in slots}
    rename: dict = {}
    for old, new in pairs:
        if old in present and old != new:
            rename.setdefault(old, new)
    return drop_duplicate_headers([Slot(s.index, rename.get(s.name, s.name)) for s in slots])


def alias_sequential_move(slots: list[Slot], aliases, policy: str = "sequential_move") -> list[Slot]:
    """H8: walk the alias list in order; for each old name present, the target
    takes the old column (in place if it exists, else appended) and the old name
    is dropped. Later entries overwrite earlier ones and chains are followed.

    ``policy="sequential_move"`` is the literal behaviour, where a self-alias
    (old == new) deletes its column. ``policy="first_wins"`` applies H7 instead.
    """
    pairs = list(aliases.items()) if isinstance(aliases, Mapping) else list(aliases)
    if policy == "first_wins":
        return alias_first_wins(slots, dict(pairs))
    if policy != "sequential_move":
        raise ValueError(f"unknown alias policy {policy!r}")
    cols: dict[str, int] = {}
    for s in slots:
        cols.setdefault(s.name, s.index)
    for old, new in pairs:
        if old in cols:
            src = cols[old]
            cols[new] = src
            del cols[old]
    return [Slot(i, n) for n, i in cols.items()]


@dataclass
class MappingResult:
    slots: list[Slot]
    unmapped: list[str]
    conflicts: dict


def mapping_table_rename(names: Sequence[str], mapping: Mapping[str, str], target: Sequence[str],
                         ignore: Iterable[str] = ()) -> MappingResult:
    """H9: keep only headers whose mapped name is in the target schema, renamed.

    Returns the kept slots, the headers to report as unmapped (absent from the
    map, or mapped outside the target; ignored headers are not reported) and
    the target names claimed by more than one header (T11).
    """
    ignore = set(ignore)
    target_set = set(target)
    kept, unmapped, claims = [], [], {}
    for i, name in enumerate(names):
        if name in ignore:
            continue
        new = mapping.get(name)
        if new is not None and new in target_set:
            kept.append(Slot(i, new))
            claims.setdefault(new, []).append(name)
        else:
            unmapped.append(name)
    conflicts = {t: src for t, src in claims.items() if len(src) > 1}
    return MappingResult(kept, unmapped, conflicts)


# ------------------------------------------------------------ data-side steps

def to_positional(df: DataFrame) -> DataFrame:
    """Rename every column to its position, so duplicate or case-colliding
    headers become addressable."""
    return df.toDF(*positional_names(len(df.columns)))


def non_null_column_indices(df: DataFrame) -> set[int]:
    """Positions of columns with at least one non-null value (one aggregate pass)."""
    pos = to_positional(df)
    if not pos.columns:
        return set()
    row = pos.agg(*[F.count(F.col(c)).alias(c) for c in pos.columns]).first()
    return {i for i, c in enumerate(pos.columns) if row[c] > 0}


def select_slots(df_positional: DataFrame, slots: list[Slot], extra: Sequence[Column] = ()) -> DataFrame:
    """Project a positional DataFrame to the resolved slots (one select)."""
    return df_positional.select(*[F.col(f"_p{s.index}").alias(s.name) for s in slots], *extra)


def contested_columns(slots: list[Slot], resolve) -> list[int]:
    """Positions whose presence can change which column ends up under a name:
    all members of a group of columns that the rules map to one output name.
    Dropping any other all-null column gives the same aligned result (it
    would be null either way)."""
    base = {s.index: s.name for s in resolve(slots)}
    groups: dict = {}
    for s in slots:
        alone = resolve([s])
        # where would this column land on its own? (chained renames included)
        for r in alone:
            groups.setdefault(r.name, set()).add(s.index)
    out = set()
    for name, members in groups.items():
        if len(members) > 1:
            out |= members
    # a column that resolves alone but disappears together with the others
    # (e.g. a later move overwrote it) is contested as well
    out |= {s.index for s in slots if resolve([s]) and s.index not in base and s.index not in out}
    return sorted(out)


def resolve_names(aliases=lca_cfg.ALIASES, *, repeat_group_prefixes=lca_cfg.REPEAT_GROUP_PREFIXES,
                  second_site_prefixes=lca_cfg.SECOND_SITE_PREFIXES, alias_policy: str = "first_wins"):
    """The header rules after H3 (H4 -> H5 -> H6 -> H7/H8 -> H2) as one function on slots."""
    def resolve(ss):
        ss = drop_blank_headers(ss)
        if repeat_group_prefixes:
            ss = drop_repeat_group_columns(ss, repeat_group_prefixes)
        if second_site_prefixes:
            ss = drop_second_site_columns(ss, second_site_prefixes)
        if alias_policy == "first_wins":
            ss = alias_first_wins(ss, aliases)
        else:
            ss = alias_sequential_move(ss, aliases, policy=alias_policy)
        return drop_duplicate_headers(ss)
    return resolve


def harmonize_vintage(df: DataFrame, aliases: Mapping[str, str] = lca_cfg.ALIASES, *,
                      normalize: bool = True, drop_all_null: bool = True,
                      repeat_group_prefixes=lca_cfg.REPEAT_GROUP_PREFIXES,
                      second_site_prefixes=lca_cfg.SECOND_SITE_PREFIXES,
                      alias_policy: str = "first_wins",
                      non_null_indices: Iterable[int] | None = None, carry: int = 0) -> DataFrame:
    """H1 -> H2 -> H3 -> H4 -> H5 -> H6 -> H7 (or H8) -> H2 on one vintage.

    The order matters: duplicates go before the all-null test, and all-null
    columns go before aliasing, so an empty alias never shadows a filled one.
    The last ``carry`` columns (e.g. row-order metadata) pass through untouched.
    """
    data_cols = df.columns[: len(df.columns) - carry] if carry else df.columns
    slots = slots_of(data_cols)
    if normalize:
        slots = normalize_headers(slots)
    slots = drop_duplicate_headers(slots)
    resolve = resolve_names(aliases, repeat_group_prefixes=repeat_group_prefixes,
                            second_site_prefixes=second_site_prefixes, alias_policy=alias_policy)

    if drop_all_null:
        # H3 can only change the result where several columns compete for one
        # output name; only those columns are tested, and only when they exist
        # (one aggregate over just those columns, none in the common case)
        suspects = contested_columns(slots, resolve)
        if non_null_indices is None:
            non_null_indices = set(range(len(data_cols))) - set(suspects)
            if suspects:
                pos = to_positional(df)
                row = pos.agg(*[F.count(F.col(f"_p{i}")).alias(f"_p{i}") for i in suspects]).first()
                non_null_indices |= {i for i in suspects if row[f"_p{i}"] > 0}
        slots = drop_all_null_columns(slots, non_null_indices)
    slots = resolve(slots)
    extra = [F.col(f"_p{len(data_cols) + i}").alias(df.columns[len(data_cols) + i]) for i in range(carry)]
    return select_slots(to_positional(df), slots, extra)


def unmapped_column_report(spark, unmapped_by_year: Mapping[int, Iterable[str]]) -> DataFrame:
    """Header -> years where it was not mapped, ``", "``-joined, sorted by header.

    The input is name metadata gathered while planning; the report itself is a
    Spark aggregate so it can be written with the other outputs.
    """
    rows = [(str(name), int(year)) for year, names in unmapped_by_year.items() for name in names]
    df = spark.createDataFrame(rows, "COLUMN_NAME string, year int")
    return unmapped_report_from_pairs(df, "COLUMN_NAME", "year")


def unmapped_values(frames: Mapping[int, tuple[DataFrame, Iterable[str]]]) -> DataFrame | None:
    """H10 from the data: COLUMN_NAME, YEARS_APPEARED and N_VALUES, the values that are lost with the unmapped columns.

    ``frames``: year -> (its rows, its unmapped header names). One aggregate a year over these columns alone; a header
    that stands twice counts its first column. None where every header is mapped.
    """
    parts = []
    for year, (df, names) in frames.items():
        names = [str(n) for n in dict.fromkeys(names)]
        if not names:
            continue
        at = [df.columns.index(n) for n in names]
        pos = to_positional(df).select(*[F.col(f"_p{i}") for i in at])
        counts = pos.agg(F.array(*[F.struct(F.lit(n).alias("name"), F.count(F.col(f"_p{i}")).alias("n"))
                                   for n, i in zip(names, at)]).alias("c"))
        parts.append(counts.select(F.explode("c").alias("c")).select(F.col("c.name").alias("name"), F.lit(int(year)).alias("year"), "c.n"))
    if not parts:
        return None
    pairs = reduce(lambda a, b: a.unionByName(b), parts)
    years = F.array_sort(F.collect_list("year"))  # one per vintage
    return (pairs.groupBy(F.col("name").alias("COLUMN_NAME"))
            .agg(F.array_join(F.transform(years, lambda y: y.cast("string")), ", ").alias("YEARS_APPEARED"), F.sum("n").alias("N_VALUES"))
            .orderBy("COLUMN_NAME"))


def unmapped_report_from_pairs(pairs: DataFrame, name_col: str, year_col: str) -> DataFrame:
    """H10 over a (header, year) DataFrame."""
    years = F.array_sort(F.collect_list(F.col(year_col).cast("int")))
    return (pairs.groupBy(F.col(name_col).alias("COLUMN_NAME"))
            .agg(F.array_join(F.transform(years, lambda y: y.cast("string")), ", ").alias("YEARS_APPEARED"))
            .orderBy("COLUMN_NAME"))


def detect_form_type(filename, year, last_old_year: int = perm_cfg.LAST_OLD_FORM_YEAR) -> Column:
    """``old`` if the file name says ``old_form`` or the year is <= 2023,
    ``new`` for later years, null when the year is not a number (T14)."""
    y = as_col(year).cast("string").try_cast("int")
    return (F.when(F.lower(as_col(filename)).contains("old_form"), F.lit("old"))
            .when(y <= last_old_year, F.lit("old"))
            .when(y.isNotNull(), F.lit("new")))
