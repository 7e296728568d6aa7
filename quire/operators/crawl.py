"""Crawl-frontier operators over a stored page set (A11, D6, D7, E2, F5,
F6, K4).  Fetching is an equi-join of the frontier with the page table; a
URL missing from it is a failed fetch (it still counts as visited)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire.functions.html import extract_links, resolve_url
from quire.session import fits, materialize

BROADCAST_PREFIXES = 100_000


def _probe(df: DataFrame, col: str, lens: list[int], shorter_than=None) -> DataFrame:
    arr = F.array(*[F.lit(n) for n in lens])
    if shorter_than is not None:
        arr = F.filter(arr, lambda n: n < shorter_than)
    x = df.withColumn("_l", F.explode(arr))
    return x.where(F.length(col) >= F.col("_l")).withColumn("_p", F.expr(f"substring({col}, 1, _l)"))


def allowed(df: DataFrame, prefixes: DataFrame, url: str = "url", prefix: str = "prefix") -> DataFrame:
    """Keep rows whose ``url`` starts with any allowed prefix (plain
    string prefix, as in the source: ``https://a.org.evil`` passes ``https://a.org``).

    Written as equi-joins, not a theta join.  Prefixes that extend another
    allowed prefix are redundant and removed first; what is left is
    prefix-free, so a URL matches at most one prefix.  Each URL is then
    probed with its leading ``n`` characters for every distinct prefix length
    ``n`` (a short list) and semi-joined on (n, text).
    """
    p = prefixes.select(F.col(prefix).alias("_p")).where(F.col("_p").isNotNull()).distinct() \
                .withColumn("_n", F.length("_p"))
    # distinct prefix lengths: at most the length of the longest prefix
    lens = sorted(r["_n"] for r in p.select("_n").distinct().collect())
    if not lens:
        return df.limit(0)
    small = fits(p, BROADCAST_PREFIXES)

    def side(t):
        t = t.select(F.col("_n").alias("_l"), "_p")
        return F.broadcast(t) if small else t

    redundant = _probe(p.withColumnRenamed("_p", "_full"), "_full", lens, F.col("_n")) \
        .join(side(p), ["_l", "_p"], "left_semi").select(F.col("_full").alias("_p"))
    minimal = p.join(redundant, "_p", "left_anti")
    return _probe(df, url, lens).join(side(minimal), ["_l", "_p"], "left_semi").drop("_l", "_p")


def not_visited(df: DataFrame, visited: DataFrame, url: str = "url") -> DataFrame:
    """URLs absent from ``visited``, each once."""
    return df.select(url).distinct().join(visited.select(url), url, "left_anti")


def crc_shard(df: DataFrame, num_parts: int, url: str = "url", seeds: DataFrame | None = None,
              out: str = "part") -> DataFrame:
    """``crc32(url) % n``; seed URLs go to every part."""
    x = df.withColumn(out, F.pmod(F.crc32(F.col(url)), F.lit(num_parts)).cast("int"))
    if seeds is None:
        return x
    s = seeds.select(url).distinct().withColumn("_seed", F.lit(True))
    x = x.join(s, url, "left")
    every = F.sequence(F.lit(0), F.lit(num_parts - 1))
    return (x.withColumn(out, F.explode(F.when(F.col("_seed"), every).otherwise(F.array(F.col(out)))))
             .drop("_seed"))


def link_edges(pages: DataFrame, prefixes: DataFrame | None = None, url: str = "url",
               html: str = "html") -> DataFrame:
    """C10 + C11 (+ D6): ``src, dst`` for every link of every stored page."""
    e = pages.select(F.col(url).alias("src"), F.explode(extract_links(html)).alias("_h"))
    e = e.select("src", resolve_url(F.col("src"), F.col("_h")).alias("url"))
    if prefixes is not None:
        e = allowed(e, prefixes)
    return e.select("src", F.col("url").alias("dst")).distinct()


def crawl(seeds: DataFrame, edges: DataFrame, pages: DataFrame, max_pages: int | None = None,
          url: str = "url") -> DataFrame:
    """F6 + K4: breadth-first closure from ``seeds`` along ``edges`` (``src,
    dst``, already allow-listed); with ``max_pages``, at most so many URLs.

    Each round: frontier = newly discovered URLs not yet visited; with a
    budget, the round that would pass it keeps only its first URLs in (depth,
    url) order.  Output ``url, depth, fetched`` (``fetched`` = present in
    ``pages``).  Each round's frontier is checkpointed and the visited set is
    the union of those tables (compacted every 16 rounds), so lineage stays
    short and a lost executor costs at most one round.
    """
    spark = seeds.sparkSession
    # read in every round: stored once, so no round extracts links again
    edges = materialize(edges.select("src", "dst"))
    known = materialize(pages.select(F.col(url).alias("url")).distinct().withColumn("fetched", F.lit(True)))
    frontier = seeds.select(F.col(url).alias("url")).where(F.col("url").isNotNull()).distinct()
    rounds = []                 # one checkpointed table per round; visited = their union
    n_visited = 0
    depth = 0
    while True:
        room = None if max_pages is None else max_pages - n_visited
        if room is not None and room <= 0:
            break
        fr = materialize(frontier.withColumn("depth", F.lit(depth)))
        n_new = fr.count()
        if n_new == 0:
            break
        if room is not None and n_new > room:
            # the page budget is the feature here: keep the first URLs of the round
            fr = materialize(fr.orderBy("url").limit(room))
            n_new = room
        rounds.append(fr)
        if len(rounds) > 16:                                  # compact: keep the union short
            u = rounds[0]
            for r in rounds[1:]:
                u = u.unionByName(r)
            rounds = [materialize(u)]
        n_visited += n_new
        visited = rounds[0]
        for r in rounds[1:]:
            visited = visited.unionByName(r)
        fetched = fr.join(known, "url")                       # failed fetches stop here
        nxt = fetched.select(F.col("url").alias("src")).join(edges, "src").select(F.col("dst").alias("url"))
        frontier = not_visited(nxt, visited)
        depth += 1
    visited = None
    for r in rounds:
        visited = r if visited is None else visited.unionByName(r)
    if visited is None:
        return spark.createDataFrame([], "url string, depth int, fetched boolean")
    return (visited.join(known, "url", "left")
                   .select("url", F.col("depth").cast("int").alias("depth"),
                           F.coalesce("fetched", F.lit(False)).alias("fetched")))
