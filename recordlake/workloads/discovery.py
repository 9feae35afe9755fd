"""Discovery checks (X1-X10, D4) over ``pages`` and listing pages derived from them.

The oracles don't parse markup: they know from the navigation items of each page (one
plain pattern) what the derived pages were built from, and so what must be found.
"""

from pyspark.sql import functions as F

from recordlake.functions import filename_of, filter_extension, normalize_url, resolve_url
from recordlake.operators.discover import (
    classify_with_context, discover_candidates, extract_page_links, extract_table_links,
)
from recordlake.workloads import _sql as S
from recordlake.workloads._tables import table
from recordlake.workloads.dedupe import sql_normalize_url

LABELS = ["LCA Program", "PERM Program", "Prevailing Wage", "H-2A Program", "FY 2016 Report"]
HEADS = ["PERM", "H-2B", "LCA", "other"]
EXTS = [".xlsx", ".csv", ".pdf", "_fy19.XLS"]
ITEM = '<li><a href="(/[^"]*)">([^<]*)</a></li>'


def _of(values, number):
    return F.element_at(F.array(*[F.lit(x) for x in values]), (number % len(values) + 1).cast("int"))


def listing_pages(spark, d):
    """Pages whose navigation items become (a) rows of a table, each with a formatted label and its link in a nested
    table, (b) links after a closed block inside a larger one, (c) items of a list without end tags; below a
    formatted heading and above the page's own markup, which is full of elements that are never closed."""
    p = table(spark, d, "pages")
    page = F.col("page_id")
    items = F.arrays_zip(F.regexp_extract_all("html", F.lit(ITEM), 1).alias("href"),
                         F.regexp_extract_all("html", F.lit(ITEM), 2).alias("name"))
    p = p.select("page_id", "url", "html", items.alias("items"), _of(EXTS, page).alias("ext"))

    def link(x, more=""):
        return F.concat(F.lit('<a href="'), x["href"], F.lit(more), F.col("ext"), F.lit('">'), x["name"], F.lit("</a>"))

    def each(build, keep=None):
        rows = F.transform("items", lambda x, k: F.when(F.lit(True) if keep is None else k % 2 == keep, build(x, k)))
        return F.array_join(rows, "")
    rows = each(lambda x, k: F.concat(
        F.lit("<tr><td><b>"), _of(LABELS, page + k), F.lit("</b> data</td>\n<td><table><tr><td>part "), k.cast("string"),
        F.lit("</td><td>"), link(x), F.lit("</td></tr></table></td></tr>")), 0)
    listed = each(lambda x, k: F.concat(F.lit("<li>"), _of(LABELS, page + k), F.lit(": "), link(x, "_list"), F.lit(" (file)")))
    html = F.concat(
        F.lit("<h2>Files of the <em>"), _of(HEADS, page), F.lit("</em> Program</h2>"),
        F.lit("<table><tr><th>Program</th><th>Files</th></tr>"), rows, F.lit("</table><div><p>"), _of(LABELS, page + 2),
        F.lit("</p>"), each(lambda x, k: link(x), 1), F.lit("</div><ul>"), listed, F.lit("</ul>"), F.col("html"))
    return p.select("page_id", "url", html.alias("html"))


def flat_listing_pages(spark, d):
    """Pages whose navigation lists become file tables: each item is a row (program label cell, link cell)."""
    p = table(spark, d, "pages")
    h = F.replace(F.col("html"), F.lit("<li>"), F.concat(F.lit("<tr><td>"), _of(LABELS, F.col("page_id")), F.lit("</td><td>")))
    h = F.replace(h, F.lit("</li>"), F.lit("</td></tr>"))
    h = F.replace(F.replace(h, F.lit("<ul>"), F.lit("<table>")), F.lit("</ul>"), F.lit("</table>"))
    h = F.regexp_replace(h, F.lit(r'href="(/[^"]*)"'), F.concat(F.lit('href="$1'), _of(EXTS, F.col("page_id")), F.lit('"')))
    return p.select("page_id", "url", h.alias("html"))


def _label(number):
    return S.pick(f"({number}) % {len(LABELS)}", LABELS)


#: k-th navigation item of each page (from 0), n items in all; names and hrefs decoded.
SQL_ITEMS = f"""
items AS (
  SELECT page_id, url AS page_url, k, len(hrefs) AS n, {S.html_text('hrefs[k + 1]')} AS href, {S.html_text('names[k + 1]')} AS name,
         {S.pick(f'page_id % {len(EXTS)}', EXTS)} AS ext, list_transform(names, lambda x: {S.html_text('x')}) AS names
  FROM (SELECT *, unnest(range(len(hrefs))) AS k FROM (
    SELECT page_id, url, regexp_extract_all(html, {S.q(ITEM)}, 1) AS hrefs, regexp_extract_all(html, {S.q(ITEM)}, 2) AS names
    FROM pages)))"""

#: Links of the listing pages in page order: pos, href, text of the nearest enclosing block, and the labels
#: (every second one) whose headings stand before the link.
SQL_LINKS = f"""
page_links AS (
  SELECT page_id, page_url, k // 2 AS pos, href || ext AS href, name AS block, k AS upto FROM items WHERE k % 2 = 0
  UNION ALL
  SELECT page_id, page_url, (n + 1) // 2 + k // 2, href || ext,
         {_label('page_id + 2')} || array_to_string(list_filter(names, lambda x, i: i % 2 = 0), ''), n - 1 FROM items WHERE k % 2 = 1
  UNION ALL
  SELECT page_id, page_url, n + k, href || '_list' || ext, {_label('page_id + k')} || ':' || name || '(file)', n - 1 FROM items
  UNION ALL
  SELECT page_id, page_url, 2 * n + k, href, name, n - 1 FROM items),
named AS (
  SELECT *, regexp_extract(href, '([^/]*)$', 1) AS filename,
         list_filter([{S.classify("''", S.pick(f'page_id % {len(HEADS)}', HEADS))}]
                     || list_transform(range(0, upto + 1, 2), lambda j: {S.classify("''", _label('page_id + j'))}),
                     lambda x: x IS NOT NULL)[-1] AS heading FROM page_links),
classified AS (
  SELECT page_id, page_url, CAST(pos AS INTEGER) AS pos, href, filename,
         COALESCE({S.classify('filename')}, {S.classify("''", 'block')}, heading) AS program FROM named)"""

#: Table links: the outer row holds the link in its second and in its fourth cell (the nested one), the inner
#: row is a row of the outer table and of its own.
SQL_TABLES = f"""
table_links AS (
  SELECT page_id, page_url, CAST(t AS INTEGER) AS table_pos, CAST(r AS INTEGER) AS row_pos, CAST(l AS INTEGER) AS link_pos,
         CASE WHEN outermost THEN {_label('page_id + k')} || 'data' ELSE 'part ' || k END AS context, href || ext AS href
  FROM (SELECT *, unnest([0, 0, 0, k // 2 + 1]) AS t, unnest([k + 1, k + 1, k + 2, 0]) AS r, unnest([0, 1, 0, 0]) AS l,
               unnest([true, true, false, false]) AS outermost FROM items WHERE k % 2 = 0))"""


# ---- X2 + X3 + X9 + X10 + X8

def q_extract_page_links(spark, d):
    links = extract_page_links(table(spark, d, "pages"))
    return links.select("page_id", "pos", "href", filename_of("href").alias("filename"),
                        filter_extension(F.col("href")).alias("is_file"),
                        normalize_url(resolve_url(F.col("page_url"), F.col("href"))).alias("url"))


SQL_PAGE_LINKS = f"""
WITH {SQL_ITEMS}
SELECT page_id, CAST(k AS INTEGER) AS pos, href, regexp_extract(href, '([^/]*)$', 1) AS filename, {S.file_ext_ok('href')} AS is_file,
       {sql_normalize_url(S.resolve_root_relative('page_url', 'href'))} AS url
FROM items
"""


# ---- X1 and X6 (+ X5) on the derived pages

def q_extract_table_links(spark, d):
    return extract_table_links(listing_pages(spark, d)).drop("page_url")


SQL_TABLE_LINKS = f"WITH {SQL_ITEMS}, {SQL_TABLES} SELECT page_id, table_pos, row_pos, link_pos, context, href FROM table_links"


def q_classify_with_context(spark, d):
    c = classify_with_context(listing_pages(spark, d))
    return c.select("page_id", "pos", "href", "filename", "program")


SQL_CLASSIFY = f"WITH {SQL_ITEMS}, {SQL_LINKS} SELECT page_id, pos, href, filename, program FROM classified"


# ---- E6 discovery: table links first, page links second, one per canonical URL

def q_discover_candidates(spark, d):
    return discover_candidates(listing_pages(spark, d)).select("program", "url", "filename", "year", "page_id", "section")


def _sql_candidates(links: str) -> str:
    url = sql_normalize_url(S.resolve_root_relative('page_url', 'href'))
    return f"""
WITH {SQL_ITEMS}, {links},
tc AS (SELECT *, regexp_extract(href, '([^/]*)$', 1) AS filename FROM table_links WHERE {S.file_ext_ok('href')}),
allc AS (
  SELECT page_id, {S.classify('filename', 'context')} AS program, {url} AS url, filename, {S.year('filename')} AS year,
         0 AS section, table_pos AS p1, row_pos AS p2, link_pos AS p3
  FROM tc WHERE NOT {S.skip('filename', 'context')}
  UNION ALL
  SELECT page_id, program, {url}, filename, {S.year('filename')}, 1, 0, pos, 0
  FROM classified WHERE {S.file_ext_ok('href')} AND NOT {S.skip('filename')})
SELECT program, url, filename, year, page_id, section FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY section, page_id, p1, p2, p3) AS rn
  FROM allc WHERE program IS NOT NULL) WHERE rn = 1
"""


SQL_CANDIDATES = _sql_candidates(f"{SQL_LINKS}, {SQL_TABLES}")


def q_discover_candidates_tree(spark, d):
    """E6 discovery over pages with one flat table in the middle of the page's own markup."""
    return discover_candidates(flat_listing_pages(spark, d)).select("program", "url", "filename", "year", "page_id", "section")


SQL_FLAT_LINKS = f"""
classified AS (
  SELECT page_id, page_url, k AS pos, href || ext AS href, regexp_extract(href || ext, '([^/]*)$', 1) AS filename,
         COALESCE({S.classify("regexp_extract(href || ext, '([^/]*)$', 1)")}, {S.classify("''", 'name')}) AS program FROM items),
table_links AS (
  SELECT page_id, page_url, 0 AS table_pos, k AS row_pos, 0 AS link_pos, {_label('page_id')} AS context, href || ext AS href FROM items)"""


QUERIES = {
    "discover_candidates_tree": q_discover_candidates_tree,
    "extract_page_links": q_extract_page_links,
    "extract_table_links": q_extract_table_links,
    "classify_with_context": q_classify_with_context,
    "discover_candidates": q_discover_candidates,
}
ORACLE = {
    "discover_candidates_tree": _sql_candidates(SQL_FLAT_LINKS),
    "extract_page_links": SQL_PAGE_LINKS,
    "extract_table_links": SQL_TABLE_LINKS,
    "classify_with_context": SQL_CLASSIFY,
    "discover_candidates": SQL_CANDIDATES,
}
