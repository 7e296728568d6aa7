"""URL verdicts against a brute-force version."""

import re

import numpy as np

from quire.llm import urltrust as U


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fit = [(len(h + p), h + p, k) for k, h, p in U.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def brute(rows, d=0.85):
    ps = [(i, *parse(u), h or "") for i, u, h in rows]
    stat = {}
    for _, host, path, _ in ps:
        if host:
            s = stat.setdefault(host, [0, 0, 0])
            k = rule(host, path)[1]
            s[0] += 1
            s[1] += k == "allow"
            s[2] += k == "block"
    edges = {(h, m.lower()) for _, h, _, t in ps for m in re.findall(r'href="https?://([^/?#"]+)', t) if h and h != m.lower()}
    hosts = sorted(set(stat) | {x for e in edges for x in e})
    at = {h: i for i, h in enumerate(hosts)}

    def walk(pairs, col):
        seed = np.array([float(h in stat and stat[h][col] * 2 > stat[h][0]) for h in hosts])
        if not seed.sum():
            return seed
        seed /= seed.sum()
        out = np.zeros(len(hosts))
        for a, _ in pairs:
            out[at[a]] += 1
        x = seed.copy()
        for _ in range(400):
            y = np.zeros(len(hosts))
            for a, b in pairs:
                y[at[b]] += d * x[at[a]] / out[at[a]]
            x = y + (1 - y.sum()) * seed
        return x
    trust, bad = walk(edges, 1), walk({(b, a) for a, b in edges}, 2)
    # the floor: what an average link to a blocked seed brings
    evil = {h for h in stat if stat[h][2] * 2 > stat[h][0]}
    into = [b for _, b in edges if b in evil]
    floor = d * (1 - d) * np.mean([1 / len(evil) / into.count(b) for b in into]) if into else 0.0
    res = set()
    for i, h, p, _ in ps:
        r, k = rule(h, p)
        res.add((i, h, p, r, k or ("block" if h and bad[at[h]] > trust[at[h]] and bad[at[h]] >= floor * (1 - 1e-9) else "allow")))
    return res


def link(*hosts):
    return "<p>" + "".join(f'<a href="https://{h}/x">a</a><a href="/local">b</a>' for h in hosts)


ROWS = [
    (1, "http://A.Example.NET/en/1?x", link("friend.example.com", "b.example.com")),
    (2, "https://b.example.com/de/5#a", link("spam.net")), (3, "https://b.example.com/en/5", link("spam.net")),
    (4, "http://spam.net/x", link("farm.example.com")), (5, "https://farm.example.com/q", link("spam.net", "spam2.net")),
    (6, "https://farm.example.com/de/", link("spam.net")), (7, "http://example.net/en/", link("friend.example.com")),
    (8, "http://x.org/fr/1", link("friend.example.com", "y.org")), (9, "http://y.org?/fr/", None), (10, None, "x"),
    (11, "no scheme", ""), (12, "http://friend.example.com", link("x.org")), (13, "://", link("spam.net")),
    (14, "http://net/", ""), (15, "http://notexample.net/en/", ""), (16, "http://spam2.net/", link("FARM.example.com")),
    (16, "http://spam2.net/", link("FARM.example.com")), (17, "http://a://b/c", ""), (None, "http://spam.net#/", ""),
]


def test_matches_brute_force(spark):
    df = spark.createDataFrame([(a, b, c, "h", "r") for a, b, c in ROWS],
                               "page_id long, url string, html string, host string, rule string")
    got = U.judge(df, tol=1e-10).collect()
    assert len(got) == len(ROWS)
    want = brute(ROWS)
    assert {tuple(r) for r in got} == want
    assert {w[4] for w in want if w[3] is None} == {"allow", "block"}


def test_registered_tolerance_gives_the_same_verdicts(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    assert {tuple(r) for r in U.judge(df).collect()} == brute(ROWS)


def test_distrust_fades_along_a_chain(spark):
    """24 neutral hosts, each linking to the next, the last to a blocked one:
    only hosts with as much distrust as a direct link brings are blocked."""
    rows = [(i, f"http://h{i}.test/", link(f"h{i + 1}.test" if i < 23 else "evil.net")) for i in range(24)] + [(24, "http://evil.net/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in U.judge(df).collect()}
    assert [i for i, v in got.items() if v == "block"] == [23, 24] and {(r[0], r[4]) for r in brute(rows)} == set(got.items())


def test_random_graphs(spark):
    import random
    rnd = random.Random(9)
    hosts = [f"h{i}.{rnd.choice(['com', 'net', 'org', 'test', 'info'])}" for i in range(60)]
    rows = [(i, f"http://{rnd.choice(hosts)}/{rnd.choice(['fr/', 'en/', ''])}{i}", link(*rnd.sample(hosts, rnd.randint(0, 4)))) for i in range(150)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {tuple(r) for r in U.judge(df).collect()} == brute(rows)


def test_very_long_url_and_page(spark):
    rows = [(1, "http://a.test/" + "x/" * 300_000, link("evil.net") * 20_000), (2, "http://evil.net/", "<p>" * 500_000), (3, "http://" + "b." * 5000 + "net", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.verdict, len(r.host), len(r.path)) for r in U.judge(df).collect()}
    assert got == {1: ("block", 6, 600_001), 2: ("block", 8, 1), 3: ("allow", 10_003, 0)}


def test_no_links_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/", None)], "page_id long, url string, html string")
    assert [tuple(r) for r in U.judge(df).collect()] == [(1, "a.net", "/", "net/", "block")]
    assert U.judge(df.limit(0)).count() == 0
