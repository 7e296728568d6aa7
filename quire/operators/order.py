"""Order-dependent operators without a single-partition window.

The source scripts treat document order as meaning: first duplicate wins,
train is the first 90 %, packing and re-sharding walk the documents in order.
All of that reduces to a prefix sum over an explicit order key.  A global
``Window.orderBy`` would move every row into one task, so the prefix sum is
done in two phases:

1. Range boundaries of the order key are taken from a bounded sample (the
   same thing ``repartitionByRange`` does internally) and turned into a
   deterministic bucket expression — a binary search in a literal array.
2. Per-(group, bucket) totals (at most ``groups x buckets`` rows, checked
   before they are broadcast) give each bucket its base offset; a window
   partitioned by (group, bucket) adds the running sum inside the bucket.

The bucket is a pure function of the key, so nothing depends on partition
ids staying the same between jobs, and a lost executor just recomputes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Largest bucket-total table we are willing to broadcast; beyond it the
# totals are joined with a shuffle instead.
BROADCAST_ROWS = 200_000
SAMPLE_PER_BUCKET = 40


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def default_buckets(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def range_bounds(df: DataFrame, order: Sequence[str], buckets: int) -> list[tuple]:
    """``buckets - 1`` sorted boundary keys from a bounded sample."""
    if buckets <= 1:
        return []
    keys = df.select(*order)
    want = buckets * SAMPLE_PER_BUCKET
    if len(order) == 1 and dict(keys.dtypes)[order[0]] in ("bigint", "int", "smallint", "double", "float"):
        probs = [i / buckets for i in range(1, buckets)]
        qs = keys.approxQuantile(order[0], probs, 1.0 / (4 * buckets))
        return sorted({(q,) for q in qs if q is not None})
    n = keys.count()
    if n == 0:
        return []
    frac = min(1.0, 2.0 * want / n)
    sample = [tuple(r) for r in keys.sample(False, frac, seed=7).limit(4 * want).collect()]
    def rank(key):                                         # nulls first, as Spark sorts
        return [(v is not None, v if v is not None else 0) for v in key]

    sample.sort(key=rank)
    if not sample:
        return []
    step = len(sample) / buckets
    out = []
    for i in range(1, buckets):
        b = sample[min(len(sample) - 1, int(i * step))]
        if not out or rank(b) > rank(out[-1]):
            out.append(b)
    return out


def bucket_column(df: DataFrame, order: Sequence[str], bounds: list[tuple]) -> Column:
    """Number of boundaries <= key: a binary search in one literal array, so
    the expression has the same size for 8 and for 80,000 boundaries."""
    if not bounds:
        return F.lit(0)
    types = dict(df.dtypes)
    ddl = ", ".join(f"`k{i}`: {types[c]}" for i, c in enumerate(order))
    whole = [types[c] in ("bigint", "int", "smallint", "tinyint") for c in order]
    rows = json.dumps([{f"k{i}": int(v) if w and v is not None else v for i, (v, w) in enumerate(zip(b, whole))}
                       for b in bounds], default=str)
    table = F.from_json(F.lit(rows), f"array<struct<{ddl}>>")       # folded to a literal
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= len(bounds)) & (F.get(table, at + s - 1) <= key), at + s).otherwise(at))


def running_offset(df: DataFrame, order, weight=None, out: str = "offset", group=None,
                   total: str | None = None, buckets: int | None = None,
                   inclusive: bool = False) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over all rows before this one in
    ``order`` (within ``group``).  ``order`` must be unique per group and
    ascending; ``weight`` defaults to 1 (a dense 0-based index).

    ``total`` (optional) names a column holding the group's grand total.
    Shuffles: one small aggregate (partial, per bucket) and one exchange for
    the in-bucket window.  No global sort into one task.
    """
    order = _names(order)
    group = _names(group)
    buckets = buckets or default_buckets(df)
    w = F.lit(1).cast("bigint") if weight is None else (
        F.col(weight) if isinstance(weight, str) else weight).cast("bigint")
    x = df.withColumn("__ro_w", w)
    bounds = range_bounds(x, order, buckets)
    x = x.withColumn("__ro_b", bucket_column(x, order, bounds))

    tot = x.groupBy(*group, "__ro_b").agg(F.sum("__ro_w").alias("__ro_t"))
    gw = Window.partitionBy(*group)
    tot = (tot.withColumn("__ro_base", F.coalesce(
                F.sum("__ro_t").over(gw.orderBy("__ro_b").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0).cast("bigint")))
              .withColumn("__ro_gt", F.sum("__ro_t").over(gw)))
    # a null group is a group: the join on it is null-safe
    tot = tot.select(*[F.col(g).alias(f"__ro_g{i}") for i, g in enumerate(group)],
                     F.col("__ro_b").alias("__ro_gb"), "__ro_base", "__ro_gt")
    on = F.col("__ro_b") == F.col("__ro_gb")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__ro_g{i}"))
    first = [*group, *[c for c in x.columns if c not in group]]
    rows = tot.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) <= BROADCAST_ROWS:
        # bounded by groups x buckets: safe to ship to every task
        small = df.sparkSession.createDataFrame(rows, tot.schema) if rows else tot
        x = x.join(F.broadcast(small), on)
    else:
        x = x.join(tot, on)
    x = x.select(*first, "__ro_base", "__ro_gt")

    iw = (Window.partitionBy(*group, "__ro_b").orderBy(*order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = F.sum("__ro_w").over(iw)
    if not inclusive:
        local = local - F.col("__ro_w")
    x = x.withColumn(out, F.col("__ro_base") + local)
    if total:
        x = x.withColumn(total, F.col("__ro_gt"))
    return x.drop("__ro_w", "__ro_b", "__ro_base", "__ro_gt")


def dense_index(df: DataFrame, order, out: str = "idx", group=None, total: str | None = None,
                buckets: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (K1, ``enumerate``)."""
    return running_offset(df, order, None, out=out, group=group, total=total, buckets=buckets)


def shard_mod(df: DataFrame, order, num_parts: int, out: str = "shard", group=None) -> DataFrame:
    """``i % num_parts`` over the dense position (applied once)."""
    x = dense_index(df, order, out="_i", group=group)
    return x.withColumn(out, F.pmod(F.col("_i"), F.lit(num_parts)).cast("int")).drop("_i")


def train_test_split(df: DataFrame, order, train_frac: float = 0.9, out: str = "split",
                     group=None) -> DataFrame:
    """E5: the first ``floor(n * frac)`` rows (per group) are ``train``.

    Only the order key is indexed (a narrow prefix sum); the first ``test``
    key of each group — one row per group, checked before broadcasting — is
    then compared with every row by a plain filter, so wide rows (texts) are
    never shuffled.  The older ``int(frac * n)`` variant is the same for
    non-negative n.
    """
    order, group = _names(order), _names(group)
    keys = df.select(*group, *order)
    idx = dense_index(keys, order, out="_i", group=group, total="_n")
    cut_at = F.floor(F.col("_n").cast("double") * F.lit(float(train_frac)))
    cut = idx.where(F.col("_i") == cut_at).select(
        *group, F.struct(*[F.col(c).alias(c) for c in order]).alias("_cut"))
    key = F.struct(*[F.col(c).alias(c) for c in order])
    rows = cut.limit(BROADCAST_ROWS + 1).collect()
    if not group:
        # a single boundary: compare with a literal, no join at all
        if not rows:
            return df.withColumn(out, F.lit("train"))
        types = dict(df.dtypes)
        lit = F.struct(*[F.lit(rows[0]["_cut"][c]).cast(types[c]).alias(c) for c in order])
        return df.withColumn(out, F.when(key < lit, F.lit("train")).otherwise(F.lit("test")))
    if len(rows) <= BROADCAST_ROWS:
        side = F.broadcast(df.sparkSession.createDataFrame(rows, cut.schema) if rows else cut)
    else:
        side = cut
    x = df.join(side, group, "left")
    return (x.withColumn(out, F.when(F.col("_cut").isNull() | (key < F.col("_cut")), F.lit("train"))
                          .otherwise(F.lit("test")))
             .drop("_cut"))
