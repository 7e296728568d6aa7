"""URL resolution, allow-list semantics and the crawl frontier."""

from collections import deque
from urllib.parse import urljoin

from pyspark.sql import functions as F

from quire.functions.html import extract_links, extract_text, resolve_url
from quire.operators.crawl import allowed, crawl, crc_shard, link_edges

BASES = ["http://a.example/b/c/d;p?q#f", "https://h.example/x/y", "https://h.example", "https://h.example/dir/"]
HREFS = ["", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ".", "./", "..", "../", "../g",
         "../..", "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "./../g", "./g/.", "g/./h", "g/../h",
         "mailto:x@y", "https://o.example/p", "/a#x", "a//b", " /a", "\n/a", "g\nh", "\t//host", "https:g", "HTTPS://H.Example/x",
         "?", "#", "//", "///p", "  ", "g?", "g#", "/g?#", "//h?q", "//h#f", "//h/../x", "https:", "https:?y", "javascript:void(0)"]


def test_resolve_matches_urljoin(spark):
    df = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], "b string, h string")
    for r in df.select("b", "h", resolve_url("b", "h").alias("r")).collect():
        assert r.r == urljoin(r.b, r.h), (r.b, r.h)


# 12 pages over 2 hosts: cycle, self link, every link form, a missing page,
# a look-alike host and a single-quoted href.
SITE = {
    "https://h.example/": '<a href="/a">a</a><a href="https://h.example/">self</a><a href="//h.example/b">b</a>',
    "https://h.example/a": '<a href="b">b</a><a href="../c?x=1">c</a><a href="#frag">f</a>',
    "https://h.example/b": "<a href='/d'>d</a><a href=\"mailto:x@y\">m</a><a href=\"/missing\">x</a>",
    "https://h.example/c?x=1": '<a href="https://h.example.evil/">evil</a><a href="/e">e</a>',
    "https://h.example/d": '<a href="https://g.example/1">g1</a><a href="/a">a</a>',
    "https://h.example/e": '<a href="/f">f</a>',
    "https://h.example/f": '<a href="/g">g</a>',
    "https://h.example/g": '<a href="/">root</a>',
    "https://h.example.evil/": '<a href="/x">x</a>',
    "https://g.example/1": '<a href="/2">2</a>',
    "https://g.example/2": '<a href="/1">1</a>',
    "https://h.example/a#frag": "<p>fragment page</p>",
}
PREFIXES = ["https://h.example"]


def py_crawl(seeds, max_pages):
    """Breadth-first rounds, (depth, url) order, failed fetches count."""
    visited, depth, frontier, out = set(), 0, sorted(set(seeds)), []
    while frontier and len(visited) < max_pages:
        frontier = frontier[: max_pages - len(visited)]
        nxt = set()
        for u in frontier:
            visited.add(u)
            out.append((u, depth, u in SITE))
        for u in frontier:
            if u in SITE:
                import re
                for h in re.findall(r"""href=["']([^"']*)["']""", SITE[u]):
                    v = urljoin(u, h)
                    if any(v.startswith(p) for p in PREFIXES) and v not in visited:
                        nxt.add(v)
        frontier, depth = sorted(nxt), depth + 1
    return sorted(out)


def test_crawl_matches_bfs(spark):
    pages = spark.createDataFrame(list(SITE.items()), "url string, html string")
    pre = spark.createDataFrame([(p,) for p in PREFIXES], "prefix string")
    edges = link_edges(pages, pre)
    seeds = spark.createDataFrame([("https://h.example/",)], "url string")
    for budget in (100, 5, 1):
        got = sorted((r.url, r.depth, r.fetched) for r in crawl(seeds, edges, pages, max_pages=budget).collect())
        assert got == py_crawl(["https://h.example/"], budget), budget


def test_crawl_without_budget_takes_every_url(spark):
    pages = spark.range(100_001).select(F.concat(F.lit("https://h.example/"), "id").alias("url"))
    edges = spark.createDataFrame([("https://h.example/7", "https://h.example/new")], "src string, dst string")
    got = crawl(pages, edges, pages)
    assert got.count() == 100_002
    assert [tuple(r) for r in got.where("depth > 0").collect()] == [("https://h.example/new", 1, False)]


def test_allowed_is_string_prefix(spark):
    df = spark.createDataFrame([("https://h.example.evil/",), ("https://h.example/a",), ("http://h.example/",),
                                ("https://h.example/a",)], "url string")
    pre = spark.createDataFrame([("https://h.example",), ("https://h.example/a",)], "prefix string")
    got = sorted(r.url for r in allowed(df, pre).collect())
    assert got == ["https://h.example.evil/", "https://h.example/a", "https://h.example/a"]


def test_crc_shard(spark):
    import zlib
    urls = ["https://h.example/%d" % i for i in range(20)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    seeds = spark.createDataFrame([(urls[0],)], "url string")
    got = crc_shard(df, 3, seeds=seeds).collect()
    assert sorted(r.part for r in got if r.url == urls[0]) == [0, 1, 2]
    for r in got:
        if r.url != urls[0]:
            assert r.part == zlib.crc32(r.url.encode()) % 3


def test_extract_text_and_links(spark):
    html = ('<html><head><title>T</title><script>var x="</p>";</script></head><body><nav><a href="/n">n</a></nav>'
            '<!-- c --><div class="ad">buy</div><h1>Head</h1><p>One &amp; two&copy;<br>three</p>'
            "<p>four <a href='/q?a=1&amp;b=2'>link</a></p><footer>foot</footer></body></html>")
    df = spark.createDataFrame([(html,)], "h string")
    r = df.select(extract_text("h").alias("t"), extract_links("h").alias("l")).first()
    assert r.t == "Head\nOne & two©\nthree\nfour link"
    assert list(r.l) == ["/n", "/q?a=1&b=2"]


def test_numeric_references(spark):
    from quire.functions.html import decode_entities
    cases = {
        "caf&#233; &#xE9;t&#XE9; &#8364; &#128512;!": "café été € 😀!",
        "&amp;#233; stays": "&#233; stays",
        "&#; &#xZZ; &#55296; &#0; tail &#": "&#; &#xZZ; &#55296; &#0; tail &#",
        "&lt;b&gt; &#60;i&#62;": "<b> <i>",
        "&#00000233; &#x0000E9; &eacute;&Eacute; &euro; &unknown; &amp;lt; &": "é é éÉ € &unknown; &lt; &",
        "no refs": "no refs",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.d for r in df.select("s", decode_entities("s").alias("d")).collect()}
    assert got == cases


def test_extract_text_by_rule(spark):
    cases = {
        "<p>1 < 2 and 3 > 2</p>": "1 < 2 and 3 > 2",
        "<p>a</p><script>var x = 1;": "a",
        "<p>a</p><style type='x'>p{}": "a",
        "<div class=ad>buy</div><p>b</p>": "b",
        "<div class='top ad'>buy</div><p>c</p>": "c",
        "<div id=x class=ad data-y>buy</div><p>d</p>": "d",
        "<div class=\"ad banner\">buy</div><p>e</p>": "e",
        "<div class=address>kept</div><p>f</p>": "kept\nf",
        "<?xml version='1'?><!DOCTYPE html><b>g</b>": "g",
        "x<br/>y<BR>z": "x\ny\nz",
    }
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    assert {r.h: r.t for r in df.select("h", extract_text("h").alias("t")).collect()} == cases


def test_lines_repeated_over_a_host(spark):
    from quire.operators.boilerplate import drop_repeated_lines
    rows = [(i, f"https://A.example/{i}", f"Menu\nstory {i}\n\nImprint") for i in range(6)]
    rows += [(6, "https://a.example/x", "Menu"), (7, "https://b.example/", "Menu\nImprint"), (8, None, "Menu"), (9, "https://b.example/2", "other")]
    df = spark.createDataFrame(rows, "page_id long, url string, text string")
    got = {r.page_id: r.text for r in drop_repeated_lines(df).collect()}
    assert got == {**{i: f"story {i}\n" for i in range(6)}, 6: "", 7: "Menu\nImprint", 8: "Menu", 9: "other"}
