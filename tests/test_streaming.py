"""Stream = batch for the incremental stages."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from quire.operators.pack import pack_sequences
from quire.operators.vocab import encode, whitespace_vocab
from quire.streaming import incremental as M


def test_stream_pack_carries_tail_across_batches(spark):
    texts = ["a b c d e", "f g", "h i j k l m n", "o", "p q r s t u v w x y z"]
    d = tempfile.mkdtemp(prefix="quire-drops-")
    schema = "doc_id long, text string"
    # three drops, written one after another so they arrive in order
    for k, chunk in enumerate(([0, 1], [2], [3, 4])):
        spark.createDataFrame([(i, texts[i]) for i in chunk], schema).coalesce(1) \
             .write.parquet(os.path.join(d, f"drop{k}"))
        time.sleep(1.1)
    docs = spark.createDataFrame(list(enumerate(texts)), schema)
    vocab = whitespace_vocab(docs)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
                  .option("recursiveFileLookup", "true").parquet(d)
    got = sorted((r.seq_id, list(r.input_ids)) for r in M.StreamPacker(spark, vocab, 4).run(stream).collect())
    enc = encode(docs, vocab).withColumn("split", F.lit("all"))
    exp = sorted((r.seq_id, list(r.input_ids)) for r in pack_sequences(enc, 4, order="doc_id").collect())
    assert got == exp


def test_stream_dedupe_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="quire-dd-")
    schema = "doc_id long, text string"
    for k, rows in enumerate(([(0, "x"), (1, "y")], [(2, "x"), (3, " y ")], [(4, "z")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(d, f"drop{k}"))
        time.sleep(1.1)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(d)
    out = M.run_to_table(M.dedupe_stream(s))
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 4]


SCHEMA = "doc_id long, text string"


def test_seen_table_first_arrival_wins_over_many_batches(spark):
    """Twelve batches over three merges against a plain loop: repeats inside a
    batch, of an old batch, blank and null texts, equal ids, an empty batch."""
    batches = [[(10 * b + i, f" t{(7 * b + 3 * i) % 23} ") for i in range(5)] for b in range(12)]
    batches[1] = [(15, "twice"), (11, "twice"), (11, "twice"), (12, ""), (13, None), (14, "  ")]
    batches[5] = []
    d = M.StreamDedupe(spark, buckets=4, merge_every=3)
    seen, want = set(), []
    for b, rows in enumerate(batches):
        d(spark.createDataFrame(rows, SCHEMA).coalesce(1), b)
        for i, t in sorted((i, t.strip()) for i, t in rows if t and t.strip()):
            if t not in seen:
                seen.add(t)
                want.append((i, t))
    read = lambda: sorted((r.doc_id, r.text) for r in spark.read.parquet(d.root + "/out").collect())
    assert read() == sorted(want)
    # the last batch again: same rows
    d(spark.createDataFrame(batches[11], SCHEMA).coalesce(1), 11)
    assert read() == sorted(want)
    kept = {k: sorted(int(x) for x in os.listdir(d.root.replace("file:", "") + "/" + k)) for k in ("seen", "merged")}
    assert kept == {"seen": [6, 7, 8, 9, 10, 11], "merged": [6, 9]}


def test_missing_batch_raises(spark):
    import pytest
    d = M.StreamDedupe(spark, buckets=2)
    d(spark.createDataFrame([(1, "a")], SCHEMA), 0)
    with pytest.raises(RuntimeError):
        d(spark.createDataFrame([(2, "b")], SCHEMA), 2)


def test_seen_table_as_a_stream(spark):
    df = spark.range(40).selectExpr("id as doc_id", "concat('text ', id % 7) as text")
    out = M.StreamDedupe(spark, buckets=3, merge_every=2).run(M.drop_stream(spark, M.drops(df, "doc_id", least=5), df.schema))
    assert sorted(r.doc_id for r in out.collect()) == list(range(7)) and M.batches_run >= 5


def test_queries_run_several_batches(spark):
    df = spark.range(40).selectExpr("id as doc_id", "concat('text ', id % 7) as text")
    path = M.drops(df, "doc_id", least=4)
    out = M.run_to_table(M.dedupe_stream(M.drop_stream(spark, path, df.schema)))
    assert out.count() == 7 and M.batches_run >= 3
    x = M.drop_stream(spark, path, df.schema).selectExpr("doc_id % 2 as shard", "text")
    got = M.run_to_table(M.stage_counts(x, {"raw": (F.lit(True), "text")}, by=["shard"]), mode="update", keys=["shard", "stage"])
    assert sorted((r.shard, r.stage, r.docs, r.bytes) for r in got.collect()) == [(0, "raw", 20, 140), (1, "raw", 20, 140)]
    assert M.batches_run >= 3


def test_damaged_pack_state_raises(spark):
    import pytest
    df = spark.createDataFrame([(-5, "a b c"), (2, "d e f g")], "doc_id long, text string")
    p = M.StreamPacker(spark, whitespace_vocab(df), 2)
    p(df.where("doc_id < 0"), 0)
    p(df.where("doc_id > 0"), 1)
    p(df.where("doc_id > 0"), 1)                                  # a replayed batch
    got = spark.read.parquet(p.root + "/out").orderBy("seq_id").collect()
    assert [r.seq_id for r in got] == [0, 1, 2]
    with pytest.raises(RuntimeError):
        p(df, 5)                                                  # state of batch 4 is missing


def test_drops_are_written_by_one_job_in_order(spark):
    """No pass over all rows per file, and the times of the files follow the order."""
    import glob
    df = spark.range(40).selectExpr("39 - id as doc_id", "concat('text ', id % 7) as text")
    sc = spark.sparkContext
    jobs = []
    for least in (3, 12):
        sc.setJobGroup(f"drops-{least}", "")
        path = M.drops(df, "doc_id", least=least)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"drops-{least}")))
        files = sorted(glob.glob(path.replace("file:", "") + "/*/part-*"), key=os.path.getmtime)
        ids = [sorted(r.doc_id for r in spark.read.parquet(f).collect()) for f in files]
        assert len(files) == least and sum(ids, []) == list(range(40))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_ingest_extracts_once(spark):
    """The test for empty texts and the entities read the extracted text, they do not extract again."""
    rows = [(1, "<p>a&amp;b  c</p>"), (2, None), (3, "<!-- x --> "), (4, "<p>x　\n y</p><p>z")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    out = M.ingest(pages)
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "a&b c"), (4, "x y z")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("<!--") == 1


def test_a_drop_is_read_by_many_tasks(spark):
    import glob

    import pyarrow.parquet as pq
    df = spark.range(4000).selectExpr("id as doc_id", "concat_ws('', transform(sequence(1, 20), i -> sha2(concat(id, ' ', i), 512))) as text")
    files = glob.glob(M.drops(df, "doc_id").replace("file:", "") + "/*/part-*")
    assert len(files) == 3 and min(pq.ParquetFile(f).num_row_groups for f in files) > 1


def test_pack_batch_deals_a_large_vocabulary_out_once(spark, monkeypatch):
    from quire.operators import vocab as V
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 50}" for j in range(i % 5))) for i in range(40)] + [(None, "w1 w2 w3")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = whitespace_vocab(df)
    want = sorted((r.seq_id, list(r.input_ids)) for r in pack_sequences(encode(df, vocab), 4, group=[]).collect())
    monkeypatch.setattr(V, "BROADCAST_VOCAB_ROWS", 10)
    p = M.StreamPacker(spark, vocab, 4)
    p(df.where("doc_id is null or doc_id < 13"), 0)
    p(df.where("doc_id >= 13"), 1)
    assert sorted((r.seq_id, list(r.input_ids)) for r in spark.read.parquet(p.root + "/out").collect()) == want
    plan = df.selectExpr("text as token").join(p.side.hint("merge"), "token", "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
