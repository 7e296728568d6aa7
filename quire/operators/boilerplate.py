"""C1, second pass: drop lines that repeat over the pages of a host.

Counting is one aggregation on (host, line hash), combined map-side, so a host
with a third of all pages is spread over its lines.  A line is boilerplate when
it stands on at least ``share`` of its host's pages; a host therefore has at
most ``1 / share`` times as many such lines as its average page has lines, and
they travel back to the pages as one short array per host.  Texts are never
shuffled unless the hosts' arrays are too many to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire.session import fits, materialize

BROADCAST_HOSTS = 200_000
HOST_RE = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def drop_repeated_lines(pages: DataFrame, key: str = "page_id", url: str = "url", text: str = "text",
                        min_pages: int = 3, share: float = 0.5) -> DataFrame:
    """``pages`` without the lines that stand on at least ``min_pages`` pages
    and ``share`` of all pages of their host; the other lines keep their
    order.  Blank lines never count as boilerplate."""
    x = pages.withColumn("_host", F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST_RE, 1)))
    lines = F.split(F.col(text), "\n")
    seen = x.select("_host", F.explode(F.array_distinct(F.transform(lines, lambda v: F.when(v != "", F.xxhash64(v))))).alias("_l"))
    n = seen.where("_l is not null").groupBy("_host", "_l").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_pages)
    size = x.groupBy("_host").agg(F.count(F.lit(1)).alias("_p"))
    bad = n.join(size, "_host").where(F.col("_n") >= F.col("_p") * share).groupBy("_host").agg(F.collect_set("_l").alias("_bad"))
    bad = materialize(bad)
    small = fits(bad, BROADCAST_HOSTS) and (bad.agg(F.sum(F.size("_bad"))).first()[0] or 0) <= 4_000_000
    y = x.join(F.broadcast(bad) if small else bad, "_host", "left")
    kept = F.filter(lines, lambda v: (v == "") | ~F.array_contains(F.col("_bad"), F.xxhash64(v)))
    return y.withColumn(text, F.when(F.col("_bad").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))) \
            .select(*pages.columns)
