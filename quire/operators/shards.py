"""Token-balanced re-sharding (E4) and its summary (I4); shard-local scope.

Greedy contiguous rule of the source: walk the sequences in order; before
adding one, move to the next shard when the current shard already holds at
least ``total / N`` tokens; the last shard takes the rest.

Spark form: prefix sums give every sequence its tokens-before (``cb``).  A
shard starts at the first ``cb`` that is ``>= start + step`` with ``step =
ceil(total/N)``.  With equal lengths (always true after packing) this is a
closed form.  Otherwise a start overshoots its goal by less than the longest
sequence, so the j-th start after a known one lies in a window of ``j *
longest`` tokens behind ``j * step``.  One job gathers the ``cb`` in the windows
of as many shards as a fixed number of rows allows, and binary searches among
them give the starts one by one.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, Window, functions as F

from quire.operators.order import bucket_column, running_offset
from quire.session import materialize


WINDOW_ROWS = 500_000          # longs that may lie on the driver at once


def _starts(x: DataFrame, num_shards: int, total: int, maxlen: int, rows: int,
            most: int = WINDOW_ROWS) -> list[int]:
    """First ``_cb`` of every shard.  Where sequences are short, windows hold more
    rows than expected: the job returns the ``most`` smallest, and the next one goes
    on behind the last start found among them (each finds at least one)."""
    step = -(-total // num_shards)                  # ceil(total / N)
    # k windows hold about k^2 / 2 * maxlen * rows / total rows
    batch = max(1, int((most * total / (maxlen * rows)) ** 0.5))
    x = x.select("_cb")
    if batch < num_shards - 1:                      # several jobs: read the wide rows once
        x = materialize(x)
    starts = [0]
    while len(starts) < num_shards:
        k = min(batch, num_shards - len(starts))
        gone = F.col("_cb") - F.lit(starts[-1])
        j = F.least(F.floor(gone / step), F.lit(k))  # the last start that this row can be
        near = x.where((gone >= step) & (gone < k * (step + maxlen)) & (gone < j * (step + maxlen)))
        cbs = [r[0] for r in near.orderBy("_cb").limit(most).collect()]
        for _ in range(k):
            i = bisect_left(cbs, starts[-1] + step)
            if i < len(cbs):
                starts.append(int(cbs[i]))
            elif len(cbs) < most:                   # no sequence behind the goal: the rest stays empty
                return starts
            else:
                break
    return starts


def reshard_by_tokens(df: DataFrame, num_shards: int, n: str = "n_tokens", order: str = "seq_id",
                      out: str = "shard") -> DataFrame:
    """Add ``shard`` (0..N-1).  Rows with ``n = 0`` (blank lines) are
    skipped, as in the source."""
    # several passes follow (bounds, totals, stats, start points): read the
    # input once and keep it in the shared checkpoint folder
    x = materialize(df.where(F.col(n) > 0))
    x = materialize(running_offset(x, [order], n, out="_cb", total="_tot"))
    st = x.agg(F.min(n).alias("lo"), F.max(n).alias("hi"), F.count(F.lit(1)).alias("cnt"),
               F.max("_tot").alias("tot")).first()
    if st["cnt"] == 0:
        return x.drop("_cb", "_tot").withColumn(out, F.lit(0))
    if st["lo"] == st["hi"]:
        per = -(-st["cnt"] // num_shards)            # ceil(n / N) sequences per shard
        idx = F.col("_cb") / F.lit(st["lo"])
        shard = F.least(F.lit(num_shards - 1), F.floor(idx / per))
        return x.withColumn(out, shard.cast("int")).drop("_cb", "_tot")
    starts = _starts(x, num_shards, int(st["tot"]), int(st["hi"]), int(st["cnt"]))
    bounds = [(s,) for s in starts[1:]]
    b = bucket_column(x, ["_cb"], bounds)
    return x.withColumn(out, b.cast("int")).drop("_cb", "_tot")


def reshard_summary(df: DataFrame, num_shards: int, n: str = "n_tokens", shard: str = "shard") -> DataFrame:
    """I4: per shard lines and tokens, with the total and the target."""
    per = df.groupBy(shard).agg(F.count(F.lit(1)).alias("lines"), F.sum(n).cast("bigint").alias("tokens"))
    dims = df.sparkSession.range(num_shards).select(F.col("id").cast("int").alias(shard))
    per = dims.join(per, shard, "left").select(
        shard, F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"),
        F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))
    tot = F.sum("tokens").over(Window.partitionBy())           # N rows
    return per.withColumn("total_tokens", tot.cast("bigint")) \
              .withColumn("target", F.col("total_tokens") / F.lit(float(num_shards)))
