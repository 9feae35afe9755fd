"""Discovery over a table of HTML pages (X1, X2, X6 and candidate building).

The source parses one page at a time into a tree; here every page is a row, its elements
are found by Spark expressions (``markup``: a fold over the page's tags) and everything
that needs a link's surroundings (the nearest enclosing block, the headings before it,
the cells of its table rows) is worked out inside the row. Links are exploded at the
end, so the only shuffle of discovery is the one that keeps one candidate per URL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.config import discovery
from recordlake.functions.urls import (
    classify_program, extract_year, filename_of, filter_extension, normalize_url, resolve_url, skip_deprecated,
)
from recordlake.operators import markup
from recordlake.operators.dedupe import dedupe_by_priority


def parsed_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """page_id, page_url, texts, elements, links: one row per page. Each step is a projection of
    its own, so what later steps use more than once is computed once."""
    t = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("page_url"),
                     markup.page_tokens(F.col(html_col)).alias("tokens"))
    t = t.select("page_id", "page_url", markup.token_texts("tokens").alias("texts"), markup.page_elements("tokens").alias("elements"))
    links = F.filter(F.col("elements"), lambda e: markup.is_one_of(e, "a") & e["href"].isNotNull())
    return t.withColumn("links", links)


def _within(names: tuple[str, ...], use: Callable[[Column], Column]) -> Column:
    """``use`` of the named columns as one struct, bound once: an array that a lambda reads straight from its column
    may be moved into the lambda by the optimizer and so be computed again for every item."""
    return markup.once(F.struct(*names), use)


def _element(page: Column, number: Column) -> Column:
    return F.try_element_at(page["elements"], number + 1)


def _lookup(keys: Column, values: Column, key: Column) -> Column:
    """The item of ``values`` that stands where ``key`` stands in ``keys``; null if it doesn't."""
    return markup.once(F.array_position(keys, key).cast("int"), lambda at: F.when(at > 0, F.try_element_at(values, at)))


def _with_surroundings(t: DataFrame, use_block_context: bool = True) -> DataFrame:
    """Adds ``around``: for each of ``links``, the program of its nearest enclosing block's full text or else of the
    nearest heading before it whose full text names one. Each block and each heading is classified once."""
    def program_of(page: Column, element: Column) -> Column:
        return markup.once(markup.text_of(page["texts"], element), lambda x: classify_program(F.lit(""), x))

    def block_of(link: Column) -> Column:
        return F.try_element_at(F.filter(link["up"], lambda u: markup.is_one_of(u, *discovery.CONTEXT_BLOCK_TAGS)), F.lit(1))["e"]

    def heads(page: Column) -> Column:
        some = F.filter(page["elements"], lambda e: markup.is_one_of(e, *discovery.HEADING_TAGS))
        return markup.running(F.transform(some, lambda e: program_of(page, e)), "string", lambda before, p: F.coalesce(p, before))

    def blocks(page: Column) -> Column:
        found = F.filter(F.array_distinct(F.transform(page["links"], block_of)), lambda b: b.isNotNull())
        return F.transform(found if use_block_context else F.slice(found, 1, 0), lambda b: F.struct(
            b.alias("e"), program_of(page, _element(page, b)).alias("program")))

    def around(page: Column) -> Column:
        lists = F.struct(page["blocks"]["e"].alias("e"), page["blocks"]["program"].alias("program"))
        return markup.once(lists, lambda known: F.transform(page["links"], lambda link: F.coalesce(
            _lookup(known["e"], known["program"], block_of(link)),
            F.when(link["heads"] > 0, F.try_element_at(page["head_programs"], link["heads"])))))
    t = t.withColumns({"head_programs": _within(("texts", "elements"), heads),
                       "blocks": _within(("texts", "elements", "links"), blocks)})
    return t.withColumn("around", _within(("links", "blocks", "head_programs"), around))


def _with_table_links(t: DataFrame) -> DataFrame:
    """Adds ``table_links``: one item for each (table, row of it, cell of the row but the first, link in the cell), in
    this order, however deep they nest: table_pos, row_pos, link_pos (in the row), cell, link, context, href."""
    def of_row(page: Column, link: Column, row: Column, k: Column) -> Column:
        inside = F.filter(F.slice(link["up"], F.lit(1), k), lambda c: markup.is_one_of(c, "td") & (c["e"] != row["first"]))
        around = F.filter(F.slice(link["up"], k + 2, F.lit(1 << 30)), lambda x: markup.is_one_of(x, "table"))

        def item(table: Column, cell: Column) -> Column:
            t0, r0 = _element(page, table["e"]), _element(page, row["e"])
            return F.struct(t0["tables"].alias("table_pos"), (r0["rows"] - t0["rows"]).alias("row_pos"), cell["e"].alias("cell"),
                            link["e"].alias("link"), row["first"].alias("first"), link["href"].alias("href"))
        return F.flatten(F.transform(around, lambda x: F.transform(inside, lambda c: item(x, c))))

    def of_link(page: Column, link: Column) -> Column:
        rows = F.transform(link["up"], lambda u, k: F.when(markup.is_one_of(u, "tr"), of_row(page, link, u, k)))
        return F.flatten(F.filter(rows, lambda r: r.isNotNull()))

    def cells(page: Column) -> Column:
        return F.array_sort(F.flatten(F.transform(page["links"], lambda link: of_link(page, link))))

    def contexts(page: Column) -> Column:
        return F.transform(F.array_distinct(page["cells"]["first"]), lambda e: F.struct(
            e.alias("e"), markup.text_of(page["texts"], _element(page, e)).alias("text")))

    def numbered(page: Column) -> Column:
        def count(known: Column, before: Column, c: Column) -> Column:
            same = (before["table_pos"] == c["table_pos"]) & (before["row_pos"] == c["row_pos"])
            return F.struct(c["table_pos"].alias("table_pos"), c["row_pos"].alias("row_pos"),
                            F.when(same, before["link_pos"] + 1).otherwise(0).alias("link_pos"), c["cell"].alias("cell"),
                            c["link"].alias("link"), _lookup(known["e"], known["text"], c["first"]).alias("context"),
                            c["href"].alias("href"))
        kind = "struct<table_pos:int,row_pos:int,link_pos:int,cell:int,link:int,context:string,href:string>"
        lists = F.struct(page["contexts"]["e"].alias("e"), page["contexts"]["text"].alias("text"))
        return markup.once(lists, lambda known: markup.running(page["cells"], kind, lambda before, c: count(known, before, c)))
    t = t.withColumn("cells", _within(("elements", "links"), cells))
    t = t.withColumn("contexts", _within(("texts", "elements", "cells"), contexts))
    return t.withColumn("table_links", _within(("cells", "contexts"), numbered))


def extract_page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Every ``<a href>`` of every page, in page order."""
    t = parsed_pages(pages, id_col, html_col, url_col)
    return t.select("page_id", "page_url", F.posexplode(F.transform("links", lambda x: x["href"])).alias("pos", "href"))


def classify_with_context(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                          url_col: str = "url", use_block_context: bool = True) -> DataFrame:
    """Program of each link from (a) its file name, else (b) the full text of its nearest enclosing block,
    else (c) the nearest previous heading whose full text classifies."""
    t = _with_surroundings(parsed_pages(pages, id_col, html_col, url_col), use_block_context)
    rows = _within(("texts", "links", "around"), lambda page: F.zip_with(page["links"], page["around"], lambda x, a: F.struct(
        x["href"].alias("href"), markup.text_of(page["texts"], x).alias("link_text"), a.alias("around"))))
    t = t.select("page_id", "page_url", F.posexplode(rows).alias("pos", "l")).select("page_id", "page_url", "pos", "l.*")
    fname = filename_of("href")
    return t.select("page_id", "page_url", "pos", "href", fname.alias("filename"), "link_text",
                    F.coalesce(classify_program(fname), "around").alias("program"))


def extract_table_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """For each row, at any depth, of each table, with at least two ``<td>`` at any depth: the first cell's
    full text is the context; every link of the other cells is a row, once for each cell that holds it."""
    t = _with_table_links(parsed_pages(pages, id_col, html_col, url_col))
    names = ("table_pos", "row_pos", "link_pos", "context", "href")
    # an expression, not the column itself: for a column the optimizer adds a filter on its size, pushes that down to the
    # scan and so works the page out several times more
    rows = F.transform("table_links", lambda c: F.struct(*[c[n].alias(n) for n in names]))
    return t.select("page_id", "page_url", F.explode(rows).alias("l")).select("page_id", "page_url", "l.*")


def page_candidates(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Both sections of discovery, before one candidate per URL is kept: each page is parsed once."""
    t = _with_table_links(_with_surroundings(parsed_pages(pages, id_col, html_col, url_col)))
    none = F.lit(None).cast("string")
    in_tables = F.transform("table_links", lambda c: F.struct(
        F.lit(0).alias("section"), F.array(c["table_pos"], c["row_pos"], c["link_pos"]).alias("position"), c["href"].alias("href"),
        c["context"].alias("context"), none.alias("around")))
    on_page = F.zip_with("links", "around", lambda x, a: F.struct(
        F.lit(1).alias("section"), F.array(F.lit(0), x["e"], F.lit(0)).alias("position"), x["href"].alias("href"),
        none.alias("context"), a.alias("around")))
    found = F.filter(F.concat(in_tables, on_page), lambda x: filter_extension(x["href"]))
    t = t.select("page_id", "page_url", F.explode(found).alias("l")).select("page_id", "page_url", "l.*")
    fname = filename_of("href")
    t = t.withColumn("filename", fname).where(~skip_deprecated(F.col("filename"), F.col("context")))
    program = F.coalesce(classify_program(F.col("filename"), F.col("context")), "around")
    return t.withColumn("program", program).where(F.col("program").isNotNull()).select(
        "page_id", "program", normalize_url(resolve_url(F.col("page_url"), F.col("href"))).alias("url"), "filename",
        extract_year(F.col("filename")).alias("year"), "section", "position")


def discover_candidates(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """E6 discovery: table links first, then page links; one candidate per canonical URL (D4), table section
    winning, then page and position order."""
    both = page_candidates(pages, id_col, html_col, url_col)
    best = dedupe_by_priority(both, "url", [F.col("section"), F.col("page_id"), F.col("position")])
    return best.select("program", "url", "filename", "year", "page_id", "section")
