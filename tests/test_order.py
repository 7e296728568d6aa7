"""Distributed prefix sums, dense index, modulo shards, train/test split."""

import math
import random

from pyspark.sql import functions as F

from quire.operators.order import dense_index, running_offset, shard_mod, train_test_split


def test_running_offset_groups(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", "c"]), rnd.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, g string, w long")
    got = {r.k: (r.off, r.tot) for r in
           running_offset(df, ["k"], "w", out="off", group=["g"], total="tot", buckets=7).collect()}
    acc, tot = {}, {}
    for k, g, w in rows:
        tot[g] = tot.get(g, 0) + w
    for k, g, w in sorted(rows):
        assert got[k] == (acc.get(g, 0), tot[g])
        acc[g] = acc.get(g, 0) + w


def test_dense_index_composite_key(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 9), "w%03d" % i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string")
    got = {(r.a, r.b): r.idx for r in dense_index(df, ["a", "b"], buckets=5).collect()}
    for i, key in enumerate(sorted(rows)):
        assert got[key] == i


def test_split_sizes(spark):
    for n in (0, 1, 9, 10, 11):
        df = spark.range(n).withColumnRenamed("id", "doc_id")
        got = {r.doc_id: r.split for r in train_test_split(df, ["doc_id"], 0.9).collect()}
        cut = math.floor(n * 0.9)
        assert got == {i: ("train" if i < cut else "test") for i in range(n)}


def test_shard_mod(spark):
    df = spark.createDataFrame([(i * 3,) for i in range(20)], "doc_id long")
    got = {r.doc_id: r.shard for r in shard_mod(df, ["doc_id"], 3).collect()}
    assert got == {i * 3: i % 3 for i in range(20)}


def test_null_group_is_a_group(spark):
    from quire.operators.order import running_offset
    rows = [(i, None if i % 3 == 0 else "g", i) for i in range(12)]
    df = spark.createDataFrame(rows, "k long, g string, w long")
    got = sorted((r.k, r.s, r.t) for r in running_offset(df, ["k"], "w", out="s", group="g", total="t").collect())
    same = lambda a, b: a % 3 == 0 if b % 3 == 0 else a % 3 != 0
    assert got == [(k, sum(a for a in range(k) if same(a, k)), sum(a for a in range(12) if same(a, k))) for k in range(12)]
