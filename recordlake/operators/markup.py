"""Elements of HTML pages as Spark expressions: which tag closes which, and full texts.

A page's tokens (tags and text nodes) are one array. A fold over its tags keeps the
stack of open elements and gives every element with the places of its start and end,
so the full text of an element is a slice of the token array. Nothing is exploded or
shuffled, and a page is worked on as one row. The fold goes over blocks of tokens, so
that what it has found is copied once a block, not once a tag.

Which open elements a tag closes (``AUTO_CLOSE``, ``END_RANK``) follows the common
behaviour of lenient HTML parsers, abridged; unknown tags are ignored, and elements
that are still open at the end of the page end there. Scripts, styles and comments
split text nodes and have no text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.config.discovery import HEADING_TAGS
from recordlake.functions._col import as_col
from recordlake.functions.text import unescape_entities, ustrip

# FIXED VALUES: elements with an end tag; others (void or unknown) are ignored.
TAGS = ("a", "abbr", "address", "article", "aside", "b", "big", "blockquote", "button", "caption", "center", "cite",
        "code", "dd", "del", "div", "dl", "dt", "em", "fieldset", "figcaption", "figure", "font", "footer", "form",
        "h1", "h2", "h3", "h4", "h5", "h6", "header", "i", "ins", "label", "li", "main", "mark", "nav", "ol", "p",
        "pre", "q", "s", "section", "select", "option", "small", "span", "strong", "sub", "sup", "table", "tbody",
        "td", "tfoot", "th", "thead", "title", "tr", "tt", "u", "ul")

# FIXED VALUES: (start tags, elements of which the nearest open one ends there, elements the search stops at).
AUTO_CLOSE = (
    (("address", "article", "aside", "blockquote", "center", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2",
      "h3", "h4", "h5", "h6", "header", "li", "main", "nav", "ol", "p", "pre", "section", "table", "ul"),
     ("p",), ("table", "td", "th", "caption", "button")),
    (("li",), ("li",), ("ul", "ol", "table", "td", "th")),
    (("dd", "dt"), ("dd", "dt"), ("dl", "table", "td", "th")),
    (("option",), ("option",), ("select",)),
    (("td", "th"), ("td", "th"), ("tr", "table")),
    (("tr",), ("tr",), ("table",)),
    (("tbody", "tfoot", "thead"), ("tbody", "tfoot", "thead", "tr"), ("table",)),
    (("a",), ("a",), ("div", "li", "p", "table", "td", "th")),
)

# FIXED VALUES: an end tag doesn't reach across an open element of a higher rank (others have rank 0).
END_RANK = {"div": 1, "td": 2, "th": 2, "tr": 3, "tbody": 4, "tfoot": 4, "thead": 4, "table": 5}

_SIGN = {tag: chr(0x100 + k) for k, tag in enumerate(TAGS)}
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
TOKEN = r"""(?s)<[A-Za-z/!?][^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>|<[^>]*+>|[^<]++"""
HREF = r"""(?is)^<a\s(?:.*?[\s"'])?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
#: Tags folded between two copies of the elements found so far.
FOLD_BLOCK = 128

ENTRY = ("struct<e:int,sign:string,start:int,end:int,tables:int,rows:int,heads:int,first:int,href:string,"
         "up:array<struct<e:int,sign:string,first:int>>>")


def signs(*tags: str) -> str:
    return "".join(_SIGN[t] for t in tags)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def page_tokens(html) -> Column:
    """All tags and text nodes in order; hidden sections become ``<!>``."""
    shown = F.regexp_replace(as_col(html), HIDDEN, "<!>")
    shown = F.regexp_replace(shown, r"<(?![A-Za-z/!?])", "&lt;")
    return F.regexp_extract_all(shown, F.lit(TOKEN), 0)


def token_texts(tokens) -> Column:
    """Stripped text of each text node, decoded; empty for tags."""
    return F.transform(as_col(tokens), lambda t: F.when(t.startswith("<"), F.lit("")).otherwise(ustrip(unescape_entities(t))))


def href_of(tag: Column) -> Column:
    """The href of an ``<a ...>`` tag, entities decoded; null where it has none."""
    value = F.concat(*[F.regexp_extract(tag, HREF, k) for k in (1, 2, 3)])
    return F.when(tag.rlike(HREF), unescape_entities(value))


def page_tags(tokens) -> Column:
    """at, sign, closing, href of each tag that TAGS lists."""
    known = F.create_map(*[F.lit(x) for pair in _SIGN.items() for x in pair])

    def tag(t: Column, i: Column) -> Column:
        sign = F.try_element_at(known, F.lower(F.regexp_extract(t, r"^</?([A-Za-z][A-Za-z0-9]*)", 1)))
        return F.struct(i.cast("int").alias("at"), F.when(t.startswith("<"), sign).alias("sign"),
                        t.startswith("</").alias("closing"), F.when(sign == _SIGN["a"], href_of(t)).alias("href"))
    return F.filter(F.transform(as_col(tokens), tag), lambda t: t["sign"].isNotNull())


def _blocks(items: Column) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - 1, F.lit(0)), F.lit(FOLD_BLOCK))
    return F.transform(starts, lambda k: F.slice(items, k + 1, F.lit(FOLD_BLOCK)))


def _reach(path: Column, chars: str) -> Column:
    """Length of the part of ``path`` before the first of ``chars``."""
    return F.length(F.regexp_extract(path, f"^[^{chars}]*", 0)) if chars else F.length(path)


def _pops(path: Column, tag: Column) -> Column:
    """How many open elements (innermost first in ``path``) the tag ends."""
    sign = tag["sign"]

    def among(tags) -> Column:
        return F.lit(signs(*tags)).contains(sign)
    ranks = sorted(set(END_RANK.values()))
    limit = _reach(path, signs(*END_RANK))
    for rank in ranks:
        mine = [t for t, r in END_RANK.items() if r == rank]
        above = [t for t, r in END_RANK.items() if r > rank]
        limit = F.when(among(mine), _reach(path, signs(*above))).otherwise(limit)
    at = F.instr(path, sign)
    ended = F.when(at <= limit, at).otherwise(0)
    starts = [F.when(among(new), F.length(F.regexp_extract(path, f"^[^{signs(*old, *stop)}]*[{signs(*old)}]", 0))).otherwise(0)
              for new, old, stop in AUTO_CLOSE]
    return F.when(tag["closing"], ended).otherwise(F.greatest(*starts)).cast("int")


def _step(s: Column, tag: Column) -> Column:
    """The fold's state (path, stack, counters, found) after one tag."""
    sign, opens = tag["sign"], ~tag["closing"]

    def after(pops: Column) -> Column:
        left = F.when(pops == 0, s["stack"]).otherwise(F.slice(s["stack"], pops + 1, F.lit(1 << 30)))
        left_path = F.substr(s["path"], pops + 1)
        ended = F.transform(F.slice(s["stack"], F.lit(1), pops), lambda x: x.withField("end", tag["at"]))
        # a row's first cell is the first that starts while the row is open
        left = F.when(opens & (sign == _SIGN["td"]), F.transform(left, lambda x: F.when(
            (x["sign"] == _SIGN["tr"]) & x["first"].isNull(), x.withField("first", s["e"])).otherwise(x))).otherwise(left)
        link = opens & tag["href"].isNotNull()
        entry = F.struct(
            s["e"].alias("e"), sign.alias("sign"), tag["at"].alias("start"), F.lit(None).cast("int").alias("end"),
            s["tables"].alias("tables"), s["rows"].alias("rows"), s["heads"].alias("heads"), F.lit(None).cast("int").alias("first"),
            tag["href"].alias("href"), F.when(link, F.transform(left, lambda x: F.struct(x["e"], x["sign"], x["first"]))).alias("up"))

        def more(counter: str, *tags: str) -> Column:
            return (s[counter] + F.when(opens & F.lit(signs(*tags)).contains(sign), 1).otherwise(0)).alias(counter)
        return F.struct(
            F.when(opens, F.concat(sign, left_path)).otherwise(left_path).alias("path"),
            F.when(opens, F.concat(F.array(entry), left)).otherwise(left).alias("stack"),
            (s["e"] + F.when(opens, 1).otherwise(0)).alias("e"), more("tables", "table"), more("rows", "tr"),
            more("heads", *HEADING_TAGS), F.when(pops == 0, s["found"]).otherwise(F.concat(s["found"], ended)).alias("found"))
    return once(_pops(s["path"], tag), after)


_STATE = f"struct<path:string,stack:array<{ENTRY}>,e:int,tables:int,rows:int,heads:int,found:array<{ENTRY}>>"


def page_elements(tokens) -> Column:
    """All elements in order of their starts: e (order number), sign (of its tag), start and end (places of its tags in
    ``tokens``), tables, rows, heads (how many such elements started before), first (of a row: its first cell), and for
    a link its href and ``up``, the open elements around it, innermost first."""
    tokens = as_col(tokens)
    tags = page_tags(tokens)
    zero = F.lit(0).cast("int")
    none = F.array().cast(f"array<{ENTRY}>")
    start = F.struct(F.lit("").alias("path"), none.alias("stack"), zero.alias("e"), zero.alias("tables"), zero.alias("rows"),
                     zero.alias("heads"), none.alias("found")).cast(_STATE)
    total = F.struct(start.alias("s"), F.array().cast(f"array<array<{ENTRY}>>").alias("parts"))

    def block(acc: Column, some: Column) -> Column:
        done = F.aggregate(some, acc["s"], lambda s, t: _step(s, t).cast(_STATE))
        return once(done, lambda s: F.struct(s.withField("found", none).alias("s"),
                                             F.concat(acc["parts"], F.array(s["found"])).alias("parts")))

    return once(tags, lambda v: F.aggregate(_blocks(v), total, block, lambda acc: F.array_sort(F.concat(
        F.flatten(acc["parts"]), F.transform(acc["s"]["stack"], lambda x: x.withField("end", F.size(tokens)))))))


def text_of(texts, element: Column) -> Column:
    """Full text of an element: its text nodes, each stripped, joined."""
    return F.array_join(F.slice(as_col(texts), element["start"] + 2, element["end"] - element["start"] - 1), "")


def is_one_of(element: Column, *tags: str) -> Column:
    return F.lit(signs(*tags)).contains(element["sign"])


def running(values: Column, kind: str, step: Callable[[Column, Column], Column]) -> Column:
    """For each item ``step(result of the item before, item)``, of type ``kind``; null before the first."""
    def add(acc: Column, v: Column) -> Column:
        return once(step(acc["last"], v).cast(kind), lambda x: F.struct(
            x.alias("last"), F.concat(acc["some"], F.array(x)).alias("some")))

    def block(acc: Column, some: Column) -> Column:
        done = F.aggregate(some, F.struct(acc["last"].alias("last"), F.array().cast(f"array<{kind}>").alias("some")), add)
        return once(done, lambda d: F.struct(d["last"].alias("last"), F.concat(acc["parts"], F.array(d["some"])).alias("parts")))
    start = F.struct(F.lit(None).cast(kind).alias("last"), F.array().cast(f"array<array<{kind}>>").alias("parts"))
    return once(values, lambda v: F.aggregate(_blocks(v), start, block, lambda acc: F.flatten(acc["parts"])))
