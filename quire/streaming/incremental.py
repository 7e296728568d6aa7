"""Incremental versions of the batch stages on Structured Streaming (M1-M4).

The source scripts grow their state as data arrives (a ``seen`` hash set, a
carried token buffer, running counts).  Here:

* M1 ingest: the batch column expressions on a file stream, append sink.
* M2 dedupe: ``StreamDedupe`` keeps the hashes seen in a bucketed table on
  disk; ``dedupe_stream`` is the form with a state store, which an event-time
  column bounds (``dropDuplicatesWithinWatermark``).
* M3 pack: ``foreachBatch``; each micro-batch packs (carried tail + new
  documents), writes its full windows under its batch id (overwrite, so a
  replayed batch gives the same files) and stores the new tail (< seq_len
  ids) keyed by batch id.
* M4 counters: streaming aggregation per shard and stage, update mode.

Output and checkpoint folders live under the session's shared checkpoint
directory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.functions.html import extract_text
from quire.functions.pii import scrub
from quire.functions.text import collapse_lines, content_hash, py_strip
from quire.operators.order import bucket_column, range_bounds
from quire.operators.pack import pack_sequences
from quire.operators.vocab import encode, vocab_side
from quire.session import ensure_checkpoint_dir, materialize, store


def scratch(spark: SparkSession, tag: str) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/{tag}-{uuid.uuid4().hex}"


def ingest(pages: DataFrame, rules: str = "reference") -> DataFrame:
    """M1: pages -> scrubbed line documents (stateless)."""
    t = py_strip(extract_text("html"))
    # a filter would be pushed below the projection and extract a second time
    some = F.explode(F.filter(F.array(t), lambda s: s != ""))
    x = pages.select(F.col("page_id").alias("doc_id"), some.alias("text"))
    return x.select("doc_id", scrub(collapse_lines("text"), rules).alias("text"))


def dedupe_stream(docs: DataFrame, text: str = "text", event_time: str | None = None,
                  delay: str = "1 hour") -> DataFrame:
    """M2: first arrival of each distinct stripped text wins.  Without an
    event time the state holds every hash seen, which is the batch rule kept
    for ever; with one, copies further apart than ``delay`` count as new and
    the state is bounded by it."""
    x = docs.withColumn(text, py_strip(text)).where(F.col(text) != "").withColumn("h", content_hash(text))
    if event_time:
        return x.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["h"])
    return x.dropDuplicates(["h"])


def _write_buckets(x: DataFrame, path: str) -> None:
    x.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


class StreamDedupe:
    """M2 for ever in bounded memory: first arrival of each distinct stripped
    text wins, blank texts go.

    The hashes seen lie in Parquet under ``root``, one folder per bucket of the
    hash, so no executor holds them: a micro-batch aggregates its own rows to one
    per hash (smallest ``order`` first) and anti-joins the buckets it touches.
    Each batch writes its rows and its new hashes under its own id and
    reads only what lower ids wrote, so a replayed batch gives the same files.
    Every ``merge_every`` batches the hashes so far are written as one table,
    which replaces the tables of the batches below it (the one before is kept
    until the next, for a replay), so files and disk stay in proportion to the
    distinct texts.  Batches must come in order; a missing one raises."""

    def __init__(self, spark: SparkSession, text: str = "text", order: str = "doc_id", buckets: int = 64,
                 merge_every: int = 16, root: str | None = None):
        self.spark, self.text, self.order = spark, text, order
        self.buckets, self.every = int(buckets), int(merge_every)
        self.root = root or scratch(spark, "stream-dedupe")

    def _delete(self, *paths: str) -> None:
        for path in paths:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def _seen(self, bid: int) -> DataFrame | None:
        """Hashes written by the batches below ``bid``, with their bucket."""
        base = bid // self.every * self.every
        paths = [f"{self.root}/merged/{base}"] * (base > 0) + [f"{self.root}/seen/{i}" for i in range(base, bid)]
        missing = [p for p in paths if not path_exists(self.spark, p)]
        if missing:
            raise RuntimeError(f"batch {bid} without {missing[0]}")
        tables = [self.spark.read.schema("h string, bucket int").parquet(p) for p in paths]
        out = None
        for t in tables:
            out = t if out is None else out.unionByName(t)
        return out

    def _merge(self, bid: int) -> None:
        """The table of all batches below ``bid``, from the last one and what came since."""
        last = bid - self.every
        parts = [f"{self.root}/merged/{last}"] * (last > 0) + [f"{self.root}/seen/{i}" for i in range(last, bid)]
        x = self.spark.read.schema("h string, bucket int").parquet(parts[0])
        for p in parts[1:]:
            x = x.unionByName(self.spark.read.schema("h string, bucket int").parquet(p))
        _write_buckets(x, f"{self.root}/merged/{bid}")
        old = last - self.every
        self._delete(*[f"{self.root}/merged/{old}"] * (old > 0), *[f"{self.root}/seen/{i}" for i in range(max(old, 0), last)])

    def __call__(self, bdf: DataFrame, bid: int) -> None:
        x = bdf.withColumn(self.text, py_strip(self.text)).where(F.col(self.text) != "")
        x = materialize(x.withColumn("h", content_hash(self.text)))
        x = x.withColumn("_at", F.monotonically_increasing_id())       # ties in ``order``
        first = x.groupBy("h").agg(F.min(F.struct(self.order, "_at")).alias("_k"))
        first = first.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(self.buckets)).cast("int"))
        if bid > 0 and bid % self.every == 0 and not path_exists(self.spark, f"{self.root}/merged/{bid}/_SUCCESS"):
            self._merge(bid)
        seen = self._seen(bid)
        new = first
        if seen is not None:
            touched = [r[0] for r in first.select("bucket").distinct().collect()]     # at most ``buckets``
            new = first.join(seen.where(F.col("bucket").isin(touched)), ["bucket", "h"], "left_anti")
        new = materialize(new)
        out = x.join(new.select("h", F.col("_k._at").alias("_at")), ["h", "_at"]).drop("_at")
        out.write.mode("overwrite").parquet(f"{self.root}/out/batch={bid}")
        _write_buckets(new.select("h", "bucket"), f"{self.root}/seen/{bid}")

    def run(self, stream: DataFrame, checkpoint: str | None = None) -> DataFrame:
        ck = checkpoint or scratch(self.spark, "stream-dedupe-ckpt")
        _drain(stream.writeStream.foreachBatch(self).option("checkpointLocation", ck))
        return self.spark.read.parquet(self.root + "/out").drop("batch")


ROW_GROUP = 1 << 20          # bytes of a row group: the one file of a micro-batch is read by many tasks


def drops(df: DataFrame, order: str, least: int = 3, rows: int = 200_000) -> str:
    """Feed for the stream queries: a folder that holds ``df`` as one file per
    range of ``order`` (at least ``least``, about ``rows`` rows each), written
    all in one job; their times of modification are then set a second apart, so
    that they arrive in order."""
    spark = df.sparkSession
    n = max(least, -(-df.count() // rows))
    bounds = range_bounds(df, [order], n)
    x = df.withColumn("_b", bucket_column(df, [order], bounds)).repartitionById(len(bounds) + 1, F.col("_b"))    # a task per file
    path = scratch(spark, "drops")
    (x.withColumn("_b", F.lpad(F.col("_b").cast("string"), 10, "0"))
      .write.option("parquet.block.size", ROW_GROUP).partitionBy("_b").parquet(path))
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path + "/_b=*/part-*")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(fs.globStatus(pattern), key=lambda f: f.getPath().toString())
    last = max((f.getModificationTime() for f in found), default=0)
    for i, f in enumerate(found):                          # a few per hundred thousand rows
        fs.setTimes(f.getPath(), last - 1000 * (len(found) - i), -1)
    return path


def drop_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """One file per micro-batch, oldest first."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(path))


def stage_counts(docs: DataFrame, stages: dict, by=()) -> DataFrame:
    """M4: running ``by..., stage, docs, bytes``; ``stages`` gives a condition
    and a text column per stage name."""
    hits = F.array(*[F.when(c, F.struct(F.lit(name).alias("stage"), F.octet_length(t).alias("b")))
                     for name, (c, t) in stages.items()])
    x = docs.select(*by, F.explode(F.filter(hits, lambda s: s.isNotNull())).alias("_s"))
    return x.groupBy(*by, F.col("_s.stage").alias("stage")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("_s.b") + 1).cast("bigint").alias("bytes"))


batches_run = 0          # micro-batches of the last stream that was drained


def _drain(writer) -> None:
    global batches_run
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    batches_run = 0 if q.lastProgress is None else q.lastProgress["batchId"] + 1


def run_to_table(stream: DataFrame, mode: str = "append", keys=()) -> DataFrame:
    """Drain a stream with ``availableNow`` into a folder and read it back.
    ``update`` keeps every batch's changed rows under its batch id (a replayed
    batch overwrites itself) and returns the last row per ``keys``."""
    spark = stream.sparkSession
    out, ck = scratch(spark, "stream-out"), scratch(spark, "stream-ckpt")
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", ck)
    if mode != "update":
        _drain(w.format("parquet").option("path", out))
        return spark.read.parquet(out)
    _drain(w.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}")))
    x = spark.read.parquet(out)
    rest = [c for c in x.columns if c not in (*keys, "batch")]
    return x.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


STATE = "batch long, tail array<bigint>, next_seq long"


class StreamPacker:
    """M3: packing with a carried tail across micro-batches."""

    def __init__(self, spark: SparkSession, vocab: DataFrame, seq_len: int, root: str | None = None):
        self.spark, self.vocab, self.L = spark, vocab, int(seq_len)
        self.side = vocab_side(vocab, again=True)            # looked at and dealt out once, not once per batch
        self.root = root or scratch(spark, "stream-pack")

    def _state(self, bid: int):
        """Tail and next window number left by the batches before ``bid``; any
        trouble with an existing state raises."""
        path = self.root + "/state"
        if not path_exists(self.spark, path):
            if bid > 0:
                raise RuntimeError(f"no state before batch {bid}")
            return [], 0
        st = self.spark.read.schema(STATE).parquet(path).where(F.col("batch") == bid - 1)
        r = st.collect()
        if bid > 0 and len(r) != 1:
            raise RuntimeError(f"{len(r)} states before batch {bid}")
        return (list(r[0]["tail"]), int(r[0]["next_seq"])) if r else ([], 0)

    def _last(self, x: DataFrame, n: int) -> list:
        """The last ``n`` ids (fewer than seq_len): of the last ``n`` documents that
        have any, those that hold them."""
        keys = [F.col("part").desc(), F.col("doc_id").desc_nulls_last()]
        x = x.where(F.size("input_ids") > 0)
        rows, held, some = x.select("part", "doc_id", F.size("input_ids")).orderBy(*keys).limit(n).collect(), 0, F.lit(False)
        for part, doc, size in rows:
            if held < n:
                held, some = held + size, some | ((F.col("part") == part) & F.col("doc_id").eqNullSafe(F.lit(doc)))
        end = F.slice("input_ids", F.greatest(F.size("input_ids") - n, F.lit(0)) + 1, F.lit(max(n, 1)))
        ids = [i for r in x.where(some).select(end.alias("p"), "part", "doc_id").orderBy(*keys).collect()[::-1] for i in r["p"]]
        return ids[len(ids) - n:]

    def __call__(self, bdf: DataFrame, bid: int) -> None:
        spark, L = self.spark, self.L
        tail, next_seq = self._state(bid)
        docs = encode(bdf.select("doc_id", "text"), self.vocab, side=self.side).select("doc_id", "input_ids")
        docs = store(docs.withColumn("part", F.lit(1)), "stream-ids")
        # the carried tail comes first whatever the document ids are
        carry = spark.createDataFrame([(0, tail, 0)], "doc_id long, input_ids array<bigint>, part int")
        allx = carry.unionByName(docs)
        win = pack_sequences(allx, L, order=["part", "doc_id"], group=[])
        (win.select((F.col("seq_id") + F.lit(next_seq)).alias("seq_id"), "input_ids")
            .write.mode("overwrite").parquet(f"{self.root}/out/batch={bid}"))
        tot = allx.agg(F.sum(F.size("input_ids"))).first()[0] or 0
        new_tail, n_full = self._last(allx, int(tot) % L), int(tot) // L
        (spark.createDataFrame([(bid, new_tail, next_seq + n_full)], STATE)
              .write.mode("overwrite").parquet(f"{self.root}/state/b={bid}"))

    def run(self, stream: DataFrame) -> DataFrame:
        ck = scratch(self.spark, "stream-pack-ckpt")
        _drain(stream.writeStream.foreachBatch(self).option("checkpointLocation", ck))
        return self.spark.read.parquet(self.root + "/out").select("seq_id", "input_ids")
