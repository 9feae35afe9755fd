"""Small DuckDB SQL builders for oracle text (mirrors of the fixed-value maps)."""

STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return STRIP.format(x=x)


def recode(x: str, mapping: dict, nulls=()) -> str:
    parts = ["CASE"]
    if nulls:
        parts.append(f"WHEN {x} IN ({', '.join(q(n) for n in nulls)}) THEN NULL")
    by_out: dict = {}
    for k, v in mapping.items():
        by_out.setdefault(v, []).append(k)
    for out, keys in by_out.items():
        parts.append(f"WHEN {x} IN ({', '.join(q(k) for k in keys)}) THEN {q(out)}")
    parts.append(f"ELSE {x} END")
    return " ".join(parts)


def pick(index_expr: str, values) -> str:
    """values[index] with a 0-based integer index expression."""
    return f"([{', '.join('NULL' if v is None else q(v) for v in values)}])[CAST({index_expr} AS INTEGER) + 1]"


def html_text(x: str) -> str:
    parts = f"list_transform(string_split_regex({x}, '<[^>]*>'), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g'))"
    t = f"array_to_string({parts}, '')"
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&#x27;", "'"), ("&amp;", "&")):
        t = f"replace({t}, {q(ent)}, {q(ch)})"
    return t


def classify(fname: str, ctx: str = "''") -> str:
    from recordlake.config.discovery import PROGRAM_KEYWORDS
    c = f"lower(COALESCE({fname}, '') || ' ' || COALESCE({ctx}, ''))"
    return "CASE " + " ".join(f"WHEN contains({c}, {q(k)}) THEN {q(p)}" for k, p in PROGRAM_KEYWORDS) + " END"


def skip(fname: str, ctx: str = "''") -> str:
    from recordlake.config.discovery import RECORD_LAYOUT_MARKERS, SKIP_PATTERNS
    c = f"lower(COALESCE({fname}, '') || ' ' || COALESCE({ctx}, ''))"
    ex = " OR ".join(f"contains({c}, {q(m)})" for m in RECORD_LAYOUT_MARKERS)
    hit = " OR ".join(f"contains({c}, {q(p)})" for p in SKIP_PATTERNS)
    pdf = f"(contains({c}, 'annual') AND contains({c}, 'report') AND ends_with(lower(COALESCE({fname}, '')), '.pdf'))"
    return f"(CASE WHEN {ex} THEN false WHEN {hit} OR {pdf} THEN true ELSE false END)"


def year(fname: str) -> str:
    fy = f"regexp_extract({fname}, '(?i)fy\\s*(\\d{{2,4}})', 1)"
    plain = f"regexp_extract({fname}, '(19|20)\\d{{2}}', 0)"
    return (f"(CASE WHEN length({fy}) = 2 THEN '20' || {fy} WHEN length({fy}) > 2 THEN {fy} "
            f"WHEN length({plain}) > 0 THEN {plain} ELSE 'unknown_year' END)")


def file_ext_ok(href: str) -> str:
    from recordlake.config.discovery import VALID_EXTENSIONS
    return "(" + " OR ".join(f"ends_with(lower({href}), {q(e)})" for e in VALID_EXTENSIONS) + ")"


def resolve_root_relative(base: str, href: str) -> str:
    """Root-relative hrefs without dot segments (the only kind in the driver pages)."""
    return (f"(CASE WHEN starts_with({href}, '/') AND NOT starts_with({href}, '//') "
            f"THEN regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || {href} END)")
