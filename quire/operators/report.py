"""Counts and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def lines_bytes(df: DataFrame, text: str = "text", by=("shard",), num_shards: int | None = None,
                stage: str | None = None) -> DataFrame:
    """``wc -l`` and ``wc -c`` per shard: rows and UTF-8 bytes + 1 per
    newline.  With ``num_shards``, missing shards show 0, 0."""
    by = [by] if isinstance(by, str) else list(by)
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("lines"),
                              F.sum(F.octet_length(text) + 1).cast("bigint").alias("bytes"))
    if num_shards is not None and by == ["shard"]:
        spark: SparkSession = df.sparkSession
        dims = spark.range(num_shards).select(F.col("id").cast("int").alias("shard"))
        agg = dims.join(agg, "shard", "left").select(
            "shard", F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"),
            F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"))
    if stage is not None:
        agg = agg.select(F.lit(stage).alias("stage"), *agg.columns)
    return agg


def token_totals(df: DataFrame, ids: str = "input_ids", by: str = "shard") -> DataFrame:
    """Tokens per shard and the total (``shard`` null) via ``rollup``."""
    return (df.rollup(by).agg(F.sum(F.size(ids)).cast("bigint").alias("tokens"),
                              F.count(F.lit(1)).alias("sequences")))


def stage_funnel(stages: list[tuple[str, DataFrame]], text: str = "text") -> DataFrame:
    """One row per stage: documents, bytes and kept ratio vs the first."""
    parts = []
    for i, (name, df) in enumerate(stages):
        parts.append(df.agg(F.count(F.lit(1)).alias("docs"),
                            F.coalesce(F.sum(F.octet_length(text) + 1), F.lit(0)).cast("bigint").alias("bytes"))
                       .select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "docs", "bytes"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # one row per stage: a window over this tiny table is fine
    d0 = F.first("docs").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    return (out.withColumn("_d0", d0)
               .withColumn("kept_per_mille", F.when(F.col("_d0") > 0,
                                                    F.floor(F.col("docs") * 1000 / F.col("_d0"))).cast("bigint"))
               .drop("_d0"))


# The line formats of the source's end report
SIZE_HEAD = " type  | shard | lines | bytes"
SIZE_LINE = "%6s | %5d | %5d | %5d"
TOKEN_LINE = " Thread %d: %d tokens"
TOTAL_LINE = " Total tokens across all threads: %d"


def end_report(packed: DataFrame, num_shards: int, ids: str = "input_ids", split: str = "split",
               shard: str = "shard") -> DataFrame:
    """``ord, value``, the lines of the end report over packed sequences: lines
    and bytes of every (shard, train/test) file, zero for those without rows, then
    the train tokens per shard and in all.  One aggregate over the sequences;
    everything behind it has two rows per shard.  Write it with
    ``sinks.write_text(..., order="ord")``, read it with ``read_text_ordered``."""
    spark = packed.sparkSession
    # a line is its ids joined by one space and a line break
    size = F.aggregate(F.col(ids), F.lit(0).cast("bigint"), lambda n, i: n + F.length(i.cast("string")) + 1)
    per = packed.groupBy(F.col(shard).cast("int").alias("_s"), F.col(split).alias("_t")).agg(
        F.count(F.lit(1)).alias("_l"), F.sum(F.greatest(size, F.lit(1))).cast("bigint").alias("_b"),
        F.sum(F.size(ids)).cast("bigint").alias("_k"))
    kinds = F.explode(F.array(*[F.struct(F.lit(i).alias("_o"), F.lit(t).alias("_t")) for i, t in enumerate(("train", "test"))]))
    files = spark.range(num_shards).select(F.col("id").cast("int").alias("_s"), kinds.alias("_x")).select("_s", "_x.*")
    rows = files.join(F.broadcast(per) if num_shards <= 100_000 else per, ["_s", "_t"], "left").na.fill(0, ["_l", "_b", "_k"])
    train = rows.where(F.col("_t") == "train")

    def lines(df, part, value, s=F.lit(0), o=F.lit(0)):
        return df.select(F.lit(part).alias("_p"), s.cast("int").alias("_s"), o.alias("_o"), value.alias("value"))

    out = (lines(spark.range(1), 0, F.lit(SIZE_HEAD))
           .unionByName(lines(rows, 1, F.format_string(SIZE_LINE, "_t", "_s", "_l", "_b"), F.col("_s"), F.col("_o")))
           .unionByName(lines(train, 2, F.format_string(TOKEN_LINE, "_s", "_k"), F.col("_s")))
           .unionByName(lines(train.agg(F.coalesce(F.sum("_k"), F.lit(0)).alias("_k")), 3, F.format_string(TOTAL_LINE, "_k"))))
    at = F.row_number().over(Window.orderBy("_p", "_s", "_o")) - 1          # three lines per shard
    return out.select(at.cast("bigint").alias("ord"), "value")
