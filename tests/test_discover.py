"""X1-X10 against Python's own URL functions and the fixture cases."""

from urllib.parse import urljoin, urlsplit, urlunsplit

import pytest
from pyspark.sql import functions as F

from recordlake.functions import (
    classify_program, extract_year, filename_of, filter_extension, normalize_url, resolve_url, skip_deprecated,
)
from recordlake.operators.discover import (
    classify_with_context, discover_candidates, extract_page_links, extract_table_links,
)

BASE = "https://www.example.gov/agencies/eta/foreign-labor/performance"


def py_normalize(url):
    p = urlsplit(url.strip())
    return urlunsplit((p.scheme.lower(), p.netloc.lower(), p.path.rstrip("/"), p.query, ""))


URLS = ["https://Ex.COM/a/b/?q=1#f", "HTTP://A.b:80/", "x/y", " https://h.org/p// ", "https://x/?q=1",
        "https://h.com/a?", "mailto:Someone@X.org", "https://h.com/a#", "//cdn.x.org/f.csv"]
HREFS = ["../x/y.xlsx", "/root.csv", "?q=2", "#frag", "https://other.org/a.csv", "//cdn.org/p.xls",
         "a/./b/../c.csv", "", "../../../../up.csv", "./", "..", "g;x?y#s"]


def test_normalize_url_matches_python(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    got = [r[0] for r in df.select(normalize_url("u")).collect()]
    assert got == [py_normalize(u) for u in URLS]


@pytest.mark.parametrize("base", [BASE, "https://h.com/a/b/c?x=1#y", "https://h.com", "https://h.com/d/"])
def test_resolve_url_matches_urljoin(spark, base):
    df = spark.createDataFrame([(h,) for h in HREFS], "h string")
    got = [r[0] for r in df.select(resolve_url(F.lit(base), F.col("h"))).collect()]
    assert got == [urljoin(base, h) for h in HREFS]


@pytest.mark.parametrize("name,year", [("FY2024", "2024"), ("LCA_FY24_Q1.xlsx", "2024"), ("fy 08.csv", "2008"),
                                       ("FY_2019.xlsx", "2019"), ("FY202.csv", "202"), ("x.csv", "unknown_year")])
def test_extract_year(spark, name, year):
    assert spark.createDataFrame([(name,)], "f string").select(extract_year("f")).first()[0] == year


def test_classify_skip_filter(spark):
    df = spark.createDataFrame([("PERM_FY2024.xlsx", ""), ("x.xlsx", "H-1B data"), ("pw.csv", "lca"),
                                ("a.xlsx", "H-2A"), ("annual report.pdf", ""), ("Record Layout FY 2016 Report.pdf", ""),
                                ("fy 2016 report.xlsx", ""), ("x.xlsx?v=1", "")], "f string, c string")
    out = df.select(classify_program("f", "c"), skip_deprecated("f", "c"), filter_extension(F.col("f")),
                    filename_of(F.col("f"))).collect()
    assert [r[0] for r in out] == ["PERM Program", "LCA Program", "LCA Program", None, None, None, None, None]
    assert [r[1] for r in out] == [False, False, False, False, True, False, True, False]
    assert [r[2] for r in out] == [True, True, True, True, False, False, True, False]


HTML = """<html><head><script>var a='<a href="/no.csv">';</script></head><body>
<h2>Latest Quarterly Updates</h2>
<table><tr><th>Program</th><th>File</th></tr>
<tr><td> LCA <b>Programs</b></td><td><a href="/files/H1B_Disclosure_FY24_Q1.xlsx">Q1</a>
 <a href='/files/Other_FY2024.csv'>other</a></td></tr>
<tr><td>only one cell <a href="/files/lonely.xlsx">x</a></td></tr>
<tr><td>FY 2016 Report</td><td><a href="/files/perm_fy2016.xlsx">r</a></td></tr>
</table>
<h3>PERM Program</h3><ul><li><a href="/files/Disclosure_FY2023.xlsx">data</a></li>
<li><a href="/files/H1B_Disclosure_FY24_Q1.xlsx#top">dup</a></li></ul>
<p>Prevailing wage data: <a href="../files/data_2019.csv">csv</a></p>
<strong>H-2A</strong><div><a href="/files/h2a_2020.xlsx">h2a</a></div>
<!-- <a href="/files/commented.csv"> -->
</body></html>"""


def test_page_and_table_links(spark):
    pages = spark.createDataFrame([(1, BASE, HTML)], "page_id long, url string, html string")
    links = [r["href"] for r in extract_page_links(pages).orderBy("pos").collect()]
    assert links[0] == "/files/H1B_Disclosure_FY24_Q1.xlsx"
    assert "/no.csv" not in links and "/files/commented.csv" not in links
    t = extract_table_links(pages).orderBy("row_pos", "link_pos").collect()
    assert [(r["context"], r["href"]) for r in t] == [
        ("LCAPrograms", "/files/H1B_Disclosure_FY24_Q1.xlsx"), ("LCAPrograms", "/files/Other_FY2024.csv"),
        ("FY 2016 Report", "/files/perm_fy2016.xlsx")]
    c = {r["href"]: r["program"] for r in classify_with_context(pages).collect()}
    assert c["/files/Disclosure_FY2023.xlsx"] == "PERM Program"      # nearest previous heading
    assert c["../files/data_2019.csv"] == "Prevailing Wage Program"  # enclosing block text
    assert c["/files/h2a_2020.xlsx"] == "PERM Program"              # H-2A heading does not classify


def test_discover_candidates(spark):
    pages = spark.createDataFrame([(1, BASE, HTML)], "page_id long, url string, html string")
    got = {r["url"]: (r["program"], r["year"], r["section"]) for r in discover_candidates(pages).collect()}
    assert got["https://www.example.gov/files/H1B_Disclosure_FY24_Q1.xlsx"] == ("LCA Program", "2024", 0)
    assert got["https://www.example.gov/files/Other_FY2024.csv"] == ("LCA Program", "2024", 0)
    assert got["https://www.example.gov/agencies/eta/files/data_2019.csv"] == ("Prevailing Wage Program", "2019", 1)
    # skipped as a deprecated report in the table, found again page-wide (no context there)
    assert got["https://www.example.gov/files/perm_fy2016.xlsx"] == ("PERM Program", "2016", 1)
    assert len([u for u in got if "H1B_Disclosure" in u]) == 1            # fragment variant deduped


NESTED = """<table><tr><td>LCA</td><td><table><tr><td>x</td><td><a href="/a.xlsx">a</a></td></tr></table></td></tr>
</table>
<h3><span>PERM</span> Program</h3>
<ul><li>Prevailing wage data: <a href="/f1.xlsx">file</a> (updated)<li><a href="/f2.xlsx">next</a></ul>
<p>intro<div><a href="/f3.csv">x</a></div>"""


def links_of(spark, html, **kw):
    pages = spark.createDataFrame([(7, BASE, html)], "page_id long, url string, html string")
    return {r["href"]: r["program"] for r in classify_with_context(pages, **kw).collect()}


def test_nested_markup(spark):
    pages = spark.createDataFrame([(7, BASE, NESTED)], "page_id long, url string, html string")
    t = sorted((r["table_pos"], r["row_pos"], r["context"], r["href"]) for r in extract_table_links(pages).collect())
    # every table and row is visited recursively, as a tree search does
    assert t == [(0, 0, "LCA", "/a.xlsx"), (0, 0, "LCA", "/a.xlsx"), (0, 1, "x", "/a.xlsx"), (1, 0, "x", "/a.xlsx")]
    c = links_of(spark, NESTED)
    assert c["/f1.xlsx"] == "Prevailing Wage Program"   # full text of the enclosing <li>
    assert c["/f2.xlsx"] == "PERM Program"              # implicitly closed <li>; heading with nested markup
    assert c["/f3.csv"] == "PERM Program"               # <div> closes the open <p>


def test_context_is_the_enclosing_block_not_the_one_before(spark):
    got = links_of(spark, "<h3>LCA</h3><div><p>PERM</p></div><a href=/x.csv>x</a>")
    assert got == {"/x.csv": "LCA Program"}              # the closed blocks don't hold the link
    got = links_of(spark, "<table><tr><td><span>PERM Program</span> data</td><td><table><tr><td>p</td><td>"
                          "<a href='/y.csv'>y</a></td></tr></table></td></tr></table>")
    assert got == {"/y.csv": None}                       # its own cell names none; the table section finds it
    got = links_of(spark, "<div>about <i>pre</i>vailing <a href='/z.csv'>wage</a></div>")
    assert got == {"/z.csv": "Prevailing Wage Program"}  # texts are stripped and joined: aboutprevailingwage


def test_markup_traps(spark):
    assert links_of(spark, '<p title="a > b"><a title="x>y" href="/a.csv">lca</a> 1 < 2 <b>perm</p>') == {"/a.csv": "LCA Program"}
    assert links_of(spark, "<div>lca<b>x</div><a href='/b.csv'>q</a>") == {"/b.csv": None}        # </div> ends the open <b>
    assert links_of(spark, "<b>pe<!-- c -->rm<table><tr><td></b><a href='/c.csv'>q</a>") == {"/c.csv": "PERM Program"}
    assert links_of(spark, "<a data-href='/no.csv'>n</a><A HREF=/d.csv>pw</A></p></td>") == {"/d.csv": None}  # no block around
    assert links_of(spark, "<strong>PERM</strong><li>x <a href='/e.csv'>q</a>", use_block_context=False) == {"/e.csv": "PERM Program"}
    empty = spark.createDataFrame([(1, BASE, None), (2, BASE, ""), (3, None, "<a href='x.csv'>lca"), (3, None, "<a href='x.csv'>lca")],
                                  "page_id long, url string, html string")
    assert extract_page_links(empty).count() == 2 and extract_table_links(empty).count() == 0
    assert [r["program"] for r in classify_with_context(empty).collect()] == [None, None]
    assert discover_candidates(empty.limit(0)).count() == 0


def py_elements(html):
    """The same rules by a plain stack over one page's tags: (name, start, end) by order of starts."""
    import re

    from recordlake.operators import markup as M
    toks = re.findall(r"<[^>]*>|[^<]+", html)
    stack, out = [], []

    def end(n, at):
        for _ in range(n):
            out.append((*stack.pop(), at))
    for at, t in enumerate(toks):
        m = re.match(r"<(/?)([a-z0-9]+)", t)
        if not m or m[2] not in M.TAGS:
            continue
        names = [x[0] for x in reversed(stack)]
        if m[1]:
            rank = M.END_RANK.get(m[2], 0)
            for k, x in enumerate(names):
                if x == m[2]:
                    end(k + 1, at)
                    break
                if M.END_RANK.get(x, 0) > rank:
                    break
            continue
        most = 0
        for new, old, stop in M.AUTO_CLOSE:
            if m[2] in new:
                for k, x in enumerate(names):
                    if x in old:
                        most = max(most, k + 1)
                    if x in old or x in stop:
                        break
        end(most, at)
        stack.append((m[2], at))
    end(len(stack), len(toks))
    return sorted((s, n, e) for n, s, e in out)


def test_elements_match_a_plain_stack(spark):
    import random

    from recordlake.operators import markup as M
    r = random.Random(5)
    names = ["p", "li", "ul", "td", "tr", "table", "div", "b", "a", "h2", "span", "tbody", "br", "zz"]
    pages = []
    for k in range(150):
        n = r.choice([0, 1, 8, 40, 400])
        pages.append((k, "".join(r.choice([f"<{r.choice(names)}>", f"</{r.choice(names)}>", "x "]) for _ in range(n))))
    df = spark.createDataFrame(pages, "k int, html string").withColumn("t", M.page_tokens("html"))
    name = {s: n for n, s in M._SIGN.items()}
    for row in df.select("k", M.page_elements("t").alias("e")).collect():
        assert [(x.start, name[x.sign], x.end) for x in row.e] == py_elements(pages[row.k][1])


def test_discovery_has_one_shuffle_and_no_python(spark):
    pages = spark.createDataFrame([(1, BASE, HTML)], "page_id long, url string, html string")
    plan = discover_candidates(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Python" not in plan and "InPandas" not in plan


def test_table_links_parse_each_page_once(spark, tmp_path):
    page = '<table><tr><td>LCA</td><td><a href="/a.xlsx">a</a></td></tr></table>'
    spark.createDataFrame([(1, "https://h.com/", page)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/p")
    links = extract_table_links(spark.read.parquet(f"{tmp_path}/p"))
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "Filter (" not in plan
    assert [tuple(r) for r in links.collect()] == [(1, "https://h.com/", 0, 0, 0, "LCA", "/a.xlsx")]
