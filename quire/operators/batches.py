"""Training-data preparation: padded batches (K2), token budget over
repeated data (K3) and step accounting (I5)."""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, Window, functions as F

from quire.operators.order import dense_index, running_offset
from quire.session import fits, materialize

PAD_ID = 0


def batch_and_pad(df: DataFrame, batch_size: int, ids: str = "input_ids", order: str = "seq_id",
                  pad_id: int = PAD_ID) -> DataFrame:
    """K2: consecutive batches of ``batch_size`` in order, right-padded with
    ``pad_id`` to the longest row of the batch; labels equal the padded ids
    (pads are not masked, as in the source collate function).
    A ``labels`` column of the input is padded likewise.  Only the order key
    is indexed; the rows are shuffled once, by batch, and a batch holds at
    most ``batch_size`` rows, so the window is bounded."""
    idx = materialize(dense_index(df.select(order), [order], out="_i"))
    x = df.join(F.broadcast(idx) if fits(idx, 2_000_000) else idx, order)
    x = x.withColumn("batch_id", F.floor(F.col("_i") / batch_size).cast("bigint")) \
         .withColumn("row", F.pmod(F.col("_i"), F.lit(batch_size)).cast("int")) \
         .withColumn("n", F.size(ids))
    x = x.withColumn("width", F.max("n").over(Window.partitionBy("batch_id")))
    padded = F.concat(F.col(ids), F.array_repeat(F.lit(pad_id), (F.col("width") - F.col("n")).cast("int")))
    labels = padded
    if "labels" in df.columns:
        labels = F.concat("labels", F.array_repeat(F.lit(pad_id), (F.col("width") - F.size("labels")).cast("int")))
    return x.select("batch_id", "row", order, "n", "width", padded.alias("input_ids"), labels.alias("labels"))


def budget_batches(df: DataFrame, batch_size: int, max_tokens: int, n: str = "n_tokens",
                   order: str = "seq_id") -> DataFrame:
    """K3: the data is read again and again; batches of ``batch_size`` run
    across epoch borders; each batch counts ``rows x width`` tokens; training
    stops after the batch that reaches ``max_tokens``.

    Output one row per step: ``step, epoch, rows, width, tokens, cum_tokens``
    (``epoch`` is that of the first row).  Batches repeat after lcm(rows,
    batch_size) rows, so the widths and running tokens of one such period are
    computed, in which a row occurs ``batch_size`` times at most, whatever the
    budget; whole periods follow by arithmetic from a range of step numbers.
    """
    spark = df.sparkSession
    x = materialize(dense_index(materialize(df.select(order, n)), [order], out="_i", total="_cnt"))
    st = x.agg(F.sum(n).alias("tok"), F.max("_cnt").alias("cnt")).first()
    if not st["cnt"] or not st["tok"]:
        return spark.createDataFrame([], "step bigint, epoch int, rows bigint, width int, tokens bigint, cum_tokens bigint")
    cnt = int(st["cnt"])
    times = batch_size // gcd(cnt, batch_size)               # epochs in a period
    size = cnt * times // batch_size                         # batches in a period
    rep = x.withColumn("_e", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("_s", F.col("_e").cast("bigint") * F.lit(cnt) + F.col("_i"))
    b = (rep.groupBy(F.floor(F.col("_s") / batch_size).cast("bigint").alias("_b"))
          .agg(F.max(n).cast("int").alias("width")))
    b = b.withColumn("tokens", F.lit(batch_size).cast("bigint") * F.col("width"))
    b = materialize(running_offset(materialize(b), ["_b"], "tokens", out="_before"))
    whole = int(b.agg(F.sum("tokens")).first()[0])
    periods, rest = divmod(max_tokens, whole)
    steps = periods * size + b.where(F.col("_before") < F.lit(rest)).count()
    out = spark.range(steps).select((F.col("id") + 1).alias("step"), F.floor(F.col("id") / size).cast("bigint").alias("_p"),
                                    F.pmod(F.col("id"), F.lit(size)).alias("_b"))
    out = out.join(F.broadcast(b) if fits(b, 2_000_000) else b, "_b")
    epoch = F.floor(F.col("_b") * F.lit(batch_size) / F.lit(cnt)) + F.col("_p") * F.lit(times)
    return out.select("step", epoch.cast("int").alias("epoch"), F.lit(batch_size).cast("bigint").alias("rows"), "width", "tokens",
                      (F.col("_p") * F.lit(whole) + F.col("_before") + F.col("tokens")).alias("cum_tokens"))


def step_log(steps: DataFrame, every: int) -> DataFrame:
    """The log lines of every ``every``-th step."""
    return steps.where(F.pmod(F.col("step"), F.lit(every)) == 0).select("step", "cum_tokens")
