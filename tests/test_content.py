"""Main-content extraction: hand-written pages and expected texts."""

import pytest

from quire.functions.content import keep_content, main_content, without_dropped

PAGES = [
    # a nested advertisement goes whole, what follows stays
    ('<div class="big ad x"><div>buy <div>now</div></div> more</div><p>The story goes on.</p>', "The story goes on."),
    # a list of links goes, a paragraph with one link stays
    ('<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a> |</li></ul>'
     '<p>A long paragraph of text that mentions <a href="/c">one link</a> and then ends.</p>',
     "A long paragraph of text that mentions one link and then ends."),
    # a short block with much link text goes, a heading that is a link stays
    ('<p>See <a href="x">this page</a> here</p><h2><a href="/t">The title</a></h2><p>Body text.</p>', "The title\nBody text."),
    # navigation inside navigation, comments, and tags in scripts
    ("<nav>a<nav>b</nav>c</nav>x<!-- <p>no</p> -->y<script>if (a < b) '<script>' </script>z", "x y z"),
    # never closed: to the end of the page; head ends at body
    ("<p>before</p><aside>rest <p>of it</p>", "before"),
    ("<head><title>t</title><body><p>text &amp; more</p>", "text & more"),
    # same name outside, self-closing, quotes and capitals
    ("<DIV><DIV CLASS='ad'>x<div/>y</DIV>kept 1 &lt; 2</DIV>", "kept 1 < 2"),
    ('<div class="add">stays</div><div class=ad>goes</div><div data-class="ad">stays too</div>', "stays\nstays too"),
    ("plain text < 3", "plain text < 3"), ("", ""), ("<footer></footer></footer>end", "end"), (None, None),
    ("<a href=x>only a link that is never closed", ""), ("<p>" * 30_000 + "deep", "deep"),
    ("<div class=ad>" * 5_000 + "x" + "</div>" * 5_000 + "end", "end"),
]


def test_pages(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PAGES)], "i int, html string")
    got = {r.i: r.t for r in df.select("i", without_dropped("html").alias("k")).select("i", main_content("k").alias("t")).collect()}
    for i, (page, want) in enumerate(PAGES):
        assert got[i] == want, (page or "")[:200]


def test_sql_agrees_on_random_pages(spark):
    import random
    import duckdb
    from quire.plans import sqlfrag as S
    rnd = random.Random(2)
    parts = ["<p>", "</p>", "<div>", "</div>", '<div class="ad">', "<nav>", "</nav>", "<a href='x'>", "</a>", "some words here ", "x", "<br/>",
             "<script>", "</script>", "<!-- c -->", "<h1>", "</h1>", "&amp;", "<", "\n", "<head>", "</head>", "<body>", "<li>", "a much longer run of plain words to read. "]
    pages = ["".join(rnd.choices(parts, k=rnd.randrange(1, 25))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = {r.i: (r.k, r.t) for r in df.select("i", without_dropped("html").alias("k")).select("i", "k", main_content("k").alias("t")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE pg (i INT, html VARCHAR)")
    con.executemany("INSERT INTO pg VALUES (?, ?)", list(enumerate(pages)))
    want = con.execute(f"WITH k AS (SELECT i, {S.keep_content('html')} AS k FROM pg) SELECT i, k, {S.main_content('k')} FROM k").fetchall()
    assert got == {i: (k, t) for i, k, t in want}


@pytest.mark.parametrize("n", [2_000])
def test_time_is_linear(n):
    import time
    page = "<div class=ad><nav>" * n + "text " * n
    t0 = time.time()
    keep_content(page * 20)
    assert time.time() - t0 < 5
