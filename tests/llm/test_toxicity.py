"""Weak supervision: label model, held-out accuracy, edge cases."""

import math
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def test_label_model_recovers_accuracies_despite_copied_votes():
    rng = np.random.default_rng(0)
    n = 4000
    truth = (rng.random(n) < 0.3).astype(int)
    good = [np.where(rng.random(n) < 0.85, truth, 1 - truth) * 2 - 1 for _ in range(4)]
    bad = np.where(rng.random(n) < 0.55, truth, 1 - truth) * 2 - 1
    votes = np.stack(good + [bad] * 6, axis=1)               # one weak voter copied six times
    y = np.where(rng.random(n) < 0.02, 1 - truth, truth)
    parent = T.dependency_tree(votes, np.where(y == 1, 0.98, 0.02))
    assert len([p for p in parent[4:] if p >= 4]) == 5       # the copies hang together
    post = T.label_model(votes, y)
    assert ((post >= 0.5) == truth).mean() > 0.97


def slow_em(votes, y, rounds=10):
    """The label model, vote by vote."""
    g = [0.98 if v == 1 else 0.02 for v in y]
    parent = T.dependency_tree(votes, np.array(g)).tolist() + [-1]
    rows = [[*map(int, r), 1 if v == 1 else -1] for r, v in zip(votes, y)]
    for _ in range(rounds):
        table = {}
        for i, p in enumerate(parent):
            for label in (0, 1):
                for a in (-1, 0, 1):
                    n = {b: 0.5 for b in (-1, 0, 1)}
                    for r, w in zip(rows, g):
                        if (r[p] if p >= 0 else 0) == a:
                            n[r[i]] += w if label else 1 - w
                    for b in n:
                        table[i, label, a, b] = n[b] / sum(n.values())
        mean, new = sum(g) / len(g), []
        for r in rows:
            yes, no = mean, 1 - mean
            for i, p in enumerate(parent):
                a = r[p] if p >= 0 else 0
                yes *= table[i, 1, a, r[i]]
                no *= table[i, 0, a, r[i]]
            new.append(yes / (yes + no))
        moved = max(abs(a - b) for a, b in zip(g, new))
        g = new
        if moved < 1e-4:
            break
    return g


def test_label_model_equals_the_slow_one():
    rng = np.random.default_rng(4)
    truth = (rng.random(120) < 0.4).astype(int)
    votes = np.stack([np.where(rng.random(120) < q, truth * 2 - 1, rng.integers(-1, 2, 120)) for q in (0.8, 0.6, 0.6, 0.3, 0.1)], axis=1)
    votes[:, 2] = votes[:, 1]
    y = np.where(rng.random(120) < 0.1, 1 - truth, truth)
    assert np.abs(T.label_model(votes, y) - slow_em(votes, y)).max() < 1e-6


def test_accuracy_of_the_labels_is_estimated():
    """A fifth of the given labels are wrong; the votes set them right."""
    rng = np.random.default_rng(3)
    truth = (rng.random(3000) < 0.5).astype(int)
    votes = np.stack([np.where(rng.random(3000) < 0.9, truth, 1 - truth) * 2 - 1 for _ in range(5)], axis=1)
    y = np.where(rng.random(3000) < 0.2, 1 - truth, truth)
    post = T.label_model(votes, y, rounds=30)
    assert ((post >= 0.5) == truth).mean() > 0.97


def test_sample_bounds_rows_not_ids(spark):
    """Two labelled ids with thousands of rows give two texts."""
    d = spark.range(6000).selectExpr("id % 2 AS doc_id", "concat('text ', cast(id AS string)) AS text").unionByName(
        spark.createDataFrame([(0, None)] * 50, "doc_id long, text string"))
    lab = spark.createDataFrame([(0, 1), (1, 0), (1, 0)], "doc_id long, toxic int")
    rows = T.one_of_each(T.sample_rows(d, lab, lambda c: F.lit(True))).collect()
    assert len(rows) == 2 and sorted(r.y for r in rows) == [0, 1]


def test_scores_equal_the_plain_version(spark):
    """Every prediction from stems, form and weights, word by word."""
    docs, labels = corpus(120)
    docs += [(500, None, 0.0), (501, "", 0.0), (502, "ZORKLY!!! " * 50, 0.0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score double")
    names, w = T.fit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), lambda c: c % 5 != 0)
    got = {r.doc_id: r.s for r in d.select("doc_id", T.scorer(spark, (names, w))(F.col("text")).alias("s")).collect()}
    for i, t, _ in docs:
        words = re.findall(r"\w+", (t or "").lower())
        c = [sum(x == n[:-1] if n.endswith("$") else x.startswith(n) and len(x) > len(n) for x in words) for n in names]
        c += [0] * (max(len(names), T.VOTERS) - len(c))
        total, distinct = sum(c), sum(x > 0 for x in c)
        x = [math.log1p(v) for v in c] + [math.log1p(total), math.log1p(distinct), total == 0, total == 1, distinct >= 2, 1.0]
        z = sum(float(a) * b for a, b in zip(x + T.form(t or "", words), w))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)


def test_linear_separates():
    x = np.array([[1, 0], [1, 1], [1, 2], [1, 3]], dtype=float)
    w = T.linear(x, np.array([0.0, 0.0, 1.0, 1.0]), 0.01)
    assert ((x @ w > 0) == [False, False, True, True]).all()


def test_capitals_share_does_not_depend_on_the_length():
    text = "AB cd, 12 ½² éß 日本 𝒳 \ud800 -- "
    short, long = (T.form(t, T.split(t)) for t in (text, text * 500))
    assert T.letter_count(text) == sum(map(str.isalpha, text)) and T.letter_count(text * 9, 7) == 9 * T.letter_count(text)
    assert len(text) * 500 > 5000 and long[0] == pytest.approx(short[0]) and T.form("", [])[0] == 0


def corpus(n=300):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randrange(5, 60))]
        bad = i % 4 == 0
        if bad:
            w += [rnd.choice(["zorkly", "zorkish", "vuxen"]) for _ in range(3)]
            rnd.shuffle(w)
        docs.append((i, " ".join(w), 0.5))
        if i % 3:
            labels.append((i, 1, int(bad)))
    return docs, labels


def test_held_out_rows_and_edge_rows(spark):
    docs, labels = corpus()
    docs += [(900, None, 0.1), (901, "", 0.1), (902, "zorkly Zorkish VUXEN zorkable", 0.1), (903, "word " * 200_000, 0.1),
             (902, "zorkly Zorkish VUXEN zorkable", 0.1), (None, "calm text", 0.1)]
    labels += [(1, 1, 0), (1, 1, 0), (5, 1, None), (None, 1, 1), (77777, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.fit(d, lab, lambda c: c % 5 != 0)
    got = d.select("doc_id", T.scorer(spark, model)(F.col("text")).alias("s")).collect()
    assert len(got) == len(docs) and all(0 <= r.s <= 1 for r in got)
    held = [(r.s >= 0.5) == (r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 5 == 0]
    assert np.mean(held) > 0.95
    s = {r.doc_id: r.s for r in got}
    assert s[902] > 0.5 and max(s[900], s[901], s[903], s[None]) < 0.5


@pytest.mark.parametrize("labels, want", [([], 0.0), ([(1, 1, 0)], 0.0), ([(1, 1, 1)], 1.0)])
def test_one_class_gives_its_share(spark, labels, want):
    d = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.fit(d, lab, lambda c: F.lit(True))
    assert [r.s for r in d.select(T.scorer(spark, model)(F.col("text")).alias("s")).collect()] == [want] * 2
    assert d.limit(0).select(T.scorer(spark, model)(F.col("text")).alias("s")).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_held_out_accuracy(spark):
    got = T.op7_toxicity_weak(spark, SF)
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    x = got.join(lab, "doc_id").where("held_out")
    n, right, false = x.count(), x.where("toxic = predicted").count(), x.where("toxic = 0 and predicted = 1").count()
    assert right / n >= 0.93 and false <= 0.02 * n
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
