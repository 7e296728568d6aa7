"""Exact top-k against a brute-force version."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from quire.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, query_id int"


def brute(rows, k):
    rows = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(rows):
        if i % 20 == 0:
            c = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(rows) if a != b)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(c[:k])]
    return sorted(out)


def check(spark, rows, k, parts):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = T.top_k(df, F.col("vec_id") % 20 == 0, k).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, k)


def test_random_ties_nulls_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(T, "FAN", 2)
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)], 1) for i in range(150)]
    rows += [(20, rows[20][1], 1), (300, None, 1), (301, [1.0, None, 1.0, 1.0], 1), (302, [float("nan")] * 4, 1),
             (303, [float("inf")] * 4, 1), (None, [1.0] * 4, 1), (340, [], 1), (360, [1.0, 1.0], 1)]
    check(spark, rows, 20, 5)
    check(spark, rows[:9], 20, 3)                      # fewer candidates than k


def test_large_components_stay_exact(spark):
    rows = [(i * 10, [float(i) * 1e6, 3.0e6 + i, -1.0], 1) for i in range(12)]
    check(spark, rows, 5, 2)


def test_query_groups(spark, monkeypatch):
    monkeypatch.setattr(T, "GROUP_BYTES", 200)
    monkeypatch.setattr(T, "TILE", 4)
    rows = [(i * 5, [math.sin(i), math.cos(i * 3)], 1) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = T.top_k(df, F.col("vec_id") % 20 == 0, 3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 3)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert T.top_k(df, F.col("vec_id") % 20 == 0).count() == 0


def test_best_breaks_ties_by_id():
    s, i = T.best(np.array([[5, 7, 7, 7, 1]]), np.array([9, 8, 2, 4, 1]), 3)
    assert s.tolist() == [[7, 7, 7]] and i.tolist() == [[2, 4, 8]]
