"""URL verdicts: host/path rules first, link-graph propagation for the rest.

Trust spreads along host links from hosts whose pages the rules mostly allow
(personalised PageRank); distrust spreads along the reversed links from hosts
whose pages they mostly block.  A host's remaining pages are blocked when its
distrust exceeds ``ratio`` times its trust and reaches a floor: what one
average link to a blocked seed brings, ``damping * (1 - damping)`` times the
mean share a seed hands to a host that links it.  So distrust that has faded
over many links blocks nothing.  Both walks run together, one join and one
partial aggregate per round over distinct host edges.  They stop when no
host's verdict can change any more (the changes still to come are less than its
distance from both bounds), at the latest when the total change falls below
``tol``; it shrinks by ``damping`` per round, so that is after about
log(tol) / log(damping) rounds on any graph.

Hot hosts: pages are reduced to distinct host edges with a map-side combine
before any shuffle; the only join that carries pages is with the list of
blocked hosts (broadcast behind a size check, else a shuffle join whose skewed
partitions Spark splits).

Defined results: a null url or one without ``://`` has an empty host and path
and no rule, and is allowed; hosts without any walk score are allowed; null
html has no links; repeated rows are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.llm.base import discard, stash, table
from quire.session import fits

AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_RULES = 1000             # rules are part of the query text
BROADCAST_HOSTS = 100_000    # their bytes are checked too
HREF = r"""(?i)\shref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def _after_scheme(url) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), AZ, az)


def rule_column(host: Column, path: Column, rules, what) -> Column:
    """``what(rule)`` of the longest fitting rule, else null.  A rule fits its
    host and all subdomains when the path starts with the rule's path."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):      # the longest ends up outermost
        fits = ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])
        out = F.when(fits, F.lit(what(r))).otherwise(out)
    return out


def parsed(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, ruled`` per row."""
    x = pages.select(F.col(key).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("_u"))
    x = x.select("page_id", _after_scheme("_u").alias("_r"))
    x = x.select("page_id", host_of(F.col("_r")).alias("host"),
                 F.regexp_extract("_r", r"^[^/?#]*([^?#]*)", 1).alias("path"))
    h, p = F.col("host"), F.col("path")
    return x.select("*", rule_column(h, p, rules, lambda r: r[1] + r[2]).alias("rule"),
                    rule_column(h, p, rules, lambda r: r[0]).alias("ruled"))


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct ``src, dst`` pairs of different hosts that pages link."""
    u = pages.select(F.coalesce(F.col(url), F.lit("")).alias("_u"), F.col(html).alias("_h"))
    e = u.select(host_of(_after_scheme("_u")).alias("src"),
                 F.explode_outer(F.array_distinct(F.regexp_extract_all("_h", F.lit(HREF), 1))).alias("dst"))
    e = e.where("dst is not null").select("src", F.translate("dst", AZ, az).alias("dst"))
    return e.where((F.col("src") != F.col("dst")) & (F.col("src") != "")).distinct()


def host_seeds(pages: DataFrame) -> DataFrame:
    """``host, kind, seed``: kind 0 = trusted, 1 = blocked; hosts most of
    whose pages have that ruling.  Seeds of a kind sum to 1."""
    c = pages.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ruled") == "allow").alias("a"),
        F.count_if(F.col("ruled") == "block").alias("b"))
    s = c.select("host", F.when(F.col("a") * 2 > F.col("n"), 0).when(F.col("b") * 2 > F.col("n"), 1).alias("kind"))
    s = s.where("kind is not null")
    n = s.groupBy("kind").agg(F.count(F.lit(1)).alias("_n"))
    return s.join(F.broadcast(n), "kind").select("host", "kind", (F.lit(1.0) / F.col("_n")).alias("seed"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tol: float = 1e-4, ratio: float = 1.0):
    """``host, kind, score`` of both walks (personalised PageRank), and the
    floor of distrust."""
    both = edges.select("src", "dst", F.lit(0).alias("kind")).unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1).alias("kind")))
    deg = both.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("_d"))
    walk = stash(both.join(deg, ["kind", "src"]).select("kind", "src", "dst", (F.lit(1.0) / F.col("_d")).alias("p")), "walk")
    seeds = stash(seeds, "seeds")
    state = first = seeds.select("host", "kind", F.col("seed").alias("score"))
    if not walk.limit(1).count() or not state.limit(1).count():
        return state, 0.0                        # no links: the walks stay on their seeds
    share = walk.where("kind = 1").join(seeds.where("kind = 1").select(F.col("host").alias("src"), "seed"), "src")
    floor = damping * (1 - damping) * (share.agg(F.avg(F.col("seed") * F.col("p"))).first()[0] or 0.0)
    while True:
        moved = (state.join(walk, (state["host"] == walk["src"]) & (state["kind"] == walk["kind"]))
                      .groupBy(walk["kind"], walk["dst"].alias("host")).agg((F.sum(F.col("score") * F.col("p")) * damping).alias("m")))
        # a walk always restarts at its seeds; what hosts without links hold goes there as well
        kept = moved.groupBy("kind").agg(F.sum("m").alias("_k"))
        home = (seeds.join(F.broadcast(kept), "kind", "left")
                     .select("host", "kind", (F.col("seed") * (1 - F.coalesce("_k", F.lit(0.0)))).alias("m")))
        new = stash(moved.select("host", "kind", "m").unionByName(home)
                         .groupBy("host", "kind").agg(F.sum("m").alias("score")), "state")
        old = state.select("host", "kind", F.col("score").alias("_o"))
        gap = new.join(old, ["host", "kind"], "full_outer").select(
            F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("_o", F.lit(0.0))))).first()[0]
        gone, state = state, new
        if gone is not first:
            discard(gone)
        if gap is None or gap < tol or _settled(state, gap * damping / (1 - damping), floor, ratio):
            return state, floor


def _both(scores: DataFrame) -> DataFrame:
    return scores.groupBy("host").agg(F.sum(F.when(F.col("kind") == 0, F.col("score")).otherwise(0.0)).alias("trust"),
                                      F.sum(F.when(F.col("kind") == 1, F.col("score")).otherwise(0.0)).alias("distrust"))


def _settled(scores: DataFrame, change: float, floor: float, ratio: float) -> bool:
    """Can no verdict change when the scores still move by ``change`` in all?"""
    if change >= floor:                          # a host not reached yet could get there
        return False
    near = F.col("distrust") >= floor - change
    open_ = (F.abs(F.col("distrust") - floor) <= change) | (F.abs(F.col("distrust") - F.col("trust") * ratio) <= change * (1 + ratio))
    return not _both(scores).where(near & open_).limit(1).count()


def blocked_hosts(scores: DataFrame, floor: float = 0.0, ratio: float = 1.0) -> DataFrame:
    """Hosts of more distrust than ``ratio`` times their trust, and no less
    than the floor (but for rounding)."""
    s = _both(scores)
    return s.where((F.col("distrust") > F.col("trust") * ratio) & (F.col("distrust") >= floor * (1 - 1e-9))).select("host")


def judge(pages: DataFrame, rules=RULES, ratio: float = 1.0, damping: float = 0.85, tol: float = 1e-4) -> DataFrame:
    """``page_id, host, path, rule, verdict`` — one row per page."""
    p = parsed(pages, rules)
    scores, floor = propagate(host_edges(pages), host_seeds(p), damping, tol, ratio)
    bad = stash(blocked_hosts(scores, floor, ratio), "blocked")
    if fits(bad, BROADCAST_HOSTS):
        bad = F.broadcast(bad)
    x = p.join(bad.withColumn("_bad", F.lit(True)), "host", "left")
    return x.select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def op9_url_trust(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
