"""Katz backoff model against a direct computation, and its normalisation."""

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import chunks as C, katz as K

SF = "/root/testdata/sf0.001"
END, START = object(), object()


def words(t):
    return (t or "").encode().lower().split() + [END]


class Brute:
    """The model of the module's docstring, from plain counters."""

    def __init__(self, texts):
        self.uni, self.big, self.ctx = Counter(), Counter(), Counter()
        for t in texts:
            w = words(t)
            self.uni.update(w)
            for h, x in zip([START, *w], w):
                self.big[h, x] += 1
                self.ctx[h] += 1
        self.n = sum(self.uni.values())
        self.d1, self.d2 = (K.good_turing([0] + [sum(c == r for c in t.values()) for r in range(1, K.K + 2)])
                            for t in (self.uni, self.big))
        self.unknown = 1 - sum(map(self.p, self.uni)) if self.n else 1.0
        self.seen = {}
        for (h, x) in self.big:
            self.seen.setdefault(h, []).append(x)
        self.weight = {}

    @staticmethod
    def disc(c, d):
        return c - K.TAIL if c > K.K else d[c] * c

    def p(self, w):
        return self.disc(self.uni[w], self.d1) / self.n if w in self.uni else self.unknown

    def alpha(self, h):
        if h not in self.weight:
            left = 1 - sum(self.disc(self.big[h, x], self.d2) for x in self.seen[h]) / self.ctx[h]
            self.weight[h] = left / (1 - sum(self.p(x) for x in self.seen[h]))
        return self.weight[h]

    def cond(self, h, w):
        if (h, w) in self.big:
            return self.disc(self.big[h, w], self.d2) / self.ctx[h]
        return self.alpha(h) * self.p(w) if h in self.ctx else self.p(w)

    def row(self, t):
        w = words(t)
        base = sum(math.log10((self.uni[x] + 1) / (self.n + len(self.uni) + 1)) for x in w)
        return len(w), sum(x in self.uni for x in w), self.n, base, sum(math.log10(self.cond(h, x)) for h, x in zip([START, *w], w))


def corpus():
    rnd = random.Random(9)
    pool = ["the", "THE", "cat", "sat", "on", "mat", *[f"w{i}" for i in range(120)]]
    weights = [40, 5, 10, 8, 9, 4, *[100 / (i + 1) for i in range(120)]]
    rows = [(i, " ".join(rnd.choices(pool, weights, k=rnd.randrange(0, 60)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "the the the the"), (503, "never seen words é"), (None, "the cat"), (10, "cat sat"),
             (10, "cat sat"), (504, "long the cat " * 3000)]
    return rows


def check(got, rows, held):
    brute = Brute([t for i, t in rows if not held(i)])
    want = sorted((str(i), held(i), *brute.row(t)) for i, t in rows)
    have = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return brute


@pytest.mark.parametrize("hot, limit", [(4, 1 << 23), (4000, 700)])
def test_scores_match_a_direct_computation(spark, monkeypatch, hot, limit):
    monkeypatch.setattr(K, "HOT", hot)                   # 4000: nearly every context is spread
    monkeypatch.setattr(C, "CHUNK", limit)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, score double, chunk string").repartition(3, "doc_id")
    got = K.score(df, F.coalesce(F.col("doc_id") % 5 != 2, F.lit(True))).collect()
    brute = check(got, rows, lambda i: i is not None and i % 5 == 2)
    for h in [START, b"the", b"mat", next(iter(brute.seen))]:      # every context sums to one
        vocab = list(brute.uni)
        assert sum(brute.cond(h, w) for w in vocab) + brute.cond(h, b"<never seen>") == pytest.approx(1, abs=1e-9)


def test_no_training_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in K.score(df, F.lit(False)).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[1].base_score, got[1].score) == (3, 0, 0, 0, 0)
    assert K.score(df.limit(0), F.lit(True)).count() == 0


def test_good_turing():
    d = K.good_turing([0, 1000, 400, 220, 140, 100, 75])
    assert ((d[1:] > 0) & (d[1:] < 1)).all()
    sparse = K.good_turing([0, 3, 0, 0, 0, 0, 0])
    assert ((sparse[1:] > 0) & (sparse[1:] < 1)).all()
    assert (K.good_turing([0] * 7)[1:] < 1).all()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = K.op4_katz_lm(spark, SF).collect()
    check(got, rows, lambda i: zlib.crc32(str(i).encode()) % 7 == 2)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
