"""Packing token ids into fixed-length windows.

Semantics of the source packer: concatenate the ids of the documents in
order, emit every full ``seq_len`` window, drop the tail, no separator token.

Spark form: each document gets its global start offset (distributed prefix
sum per split).  A window that lies inside one document is cut out of it
directly with ``slice`` — no shuffle.  Only the (at most two) pieces of a
document that touch a window shared with a neighbour go through a shuffle
keyed by (split, window); such a group holds at most ``seq_len`` ids, so hot
keys cannot occur.  The incomplete tail window is filtered out before the
shuffle.  Single tokens are never exploded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire.operators.order import running_offset


def pack_sequences(df: DataFrame, seq_len: int, ids: str = "input_ids", order: str = "doc_id",
                   group=("split",), out: str = "input_ids") -> DataFrame:
    """``group..., seq_id bigint, input_ids array<int>`` (full windows only).

    ``seq_id`` is the window's position within its group, starting at 0.
    """
    group = [group] if isinstance(group, str) else list(group or [])
    order = [order] if isinstance(order, str) else list(order)
    L = int(seq_len)
    x = df.select(*group, *order, F.col(ids).alias("_ids")).withColumn("_n", F.size("_ids").cast("bigint"))
    x = x.where(F.col("_n") > 0)
    x = running_offset(x, order, "_n", out="_s", group=group, total="_tot")
    s, n = F.col("_s"), F.col("_n")
    full = F.floor(F.col("_tot") / L)                       # windows that are complete
    first = F.floor(s / L)
    last = F.least(F.floor((s + n - 1) / L), full - 1)
    in_lo = F.ceil(s / L)                                  # windows inside the doc
    in_hi = F.least(F.floor((s + n) / L) - 1, full - 1)
    x = x.withColumn("_first", first).withColumn("_last", last) \
         .withColumn("_in_lo", in_lo).withColumn("_in_hi", in_hi)

    inner = (x.where(F.col("_in_lo") <= F.col("_in_hi"))
              .select(*group, "_s", "_ids",
                      F.explode(F.sequence(F.col("_in_lo"), F.col("_in_hi"))).alias("seq_id"))
              .select(*group, "seq_id",
                      F.slice("_ids", (F.col("seq_id") * L - F.col("_s") + 1).cast("int"), L).alias(out)))

    def shared(k):
        return (k >= F.col("_first")) & (k <= F.col("_last")) & ~((k >= F.col("_in_lo")) & (k <= F.col("_in_hi")))

    edge = (x.select(*group, "_s", "_n", "_ids",
                     F.explode(F.filter(F.array_distinct(F.array(F.col("_first"), F.col("_last"))), shared))
                      .alias("seq_id")))
    lo = F.greatest(F.col("seq_id") * L, F.col("_s"))
    hi = F.least((F.col("seq_id") + 1) * L, F.col("_s") + F.col("_n"))
    edge = edge.select(*group, "seq_id",
                       F.struct(lo.alias("p"), F.slice("_ids", (lo - F.col("_s") + 1).cast("int"),
                                                       (hi - lo).cast("int")).alias("ids")).alias("_piece"))
    joined = (edge.groupBy(*group, "seq_id")
                  .agg(F.array_sort(F.collect_list("_piece")).alias("_ps"))
                  .select(*group, "seq_id", F.flatten(F.transform("_ps", lambda p: p["ids"])).alias(out)))
    return inner.unionByName(joined).withColumn("seq_id", F.col("seq_id").cast("bigint"))


def with_labels(df: DataFrame, ids: str = "input_ids", out: str = "labels") -> DataFrame:
    """Labels are a copy of the ids (causal LM)."""
    return df.withColumn(out, F.col(ids))
