"""Hyperdimensional language ID: algebra, held-out accuracy, edge cases."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import langhd as L

SF = "/root/testdata/sf0.01"


def brute_vector(text, letters):
    """Bind and bundle letter by letter."""
    syms = [0]
    for ch in text.lower():
        if ch.isalpha():
            syms.append(ord(ch))
        elif syms[-1] != 0:
            syms.append(0)
    if syms[-1] != 0:
        syms.append(0)
    letters._learn(np.array(sorted(set(syms))))
    base = {int(c): letters.rows[-1][i].astype(int) for i, c in enumerate(letters.codes)}
    out = np.zeros(letters.dim)
    for a, b, c in zip(syms, syms[1:], syms[2:]):
        out += np.roll(base[a], 2) * np.roll(base[b], 1) * base[c]
    return out


def test_bundle_is_the_sum_of_bound_letters():
    letters = L.Letters(64)
    for text in ("A", "hello, hello  World!", "Straße 42 ñandú", "日本語 and more"):
        assert np.array_equal(letters.bundle(*letters.grams(text)), brute_vector(text, L.Letters(64)))


def test_gram_counts_add_up(spark, monkeypatch):
    monkeypatch.setattr(L, "HELD", 10)
    rows = [("x", "one two one"), ("x", "one"), ("y", "zwei"), ("y", None), ("x", "42 ?")] * 3
    got = {(r.lang, r.code): r.n for r in L.gram_counts(spark.createDataFrame(rows, "lang string, text string")).collect()}
    want = Counter()
    letters = L.Letters(8)
    for lang, t in rows:
        for c, n in zip(*letters.grams(t)):
            want[lang, int(c)] += int(n)
    assert got == dict(want)


def test_edge_rows_and_clashing_columns(spark):
    train = spark.createDataFrame([("en", "the cat and the dog"), ("de", "der hund und die katze"), (None, "x"),
                                   ("", "y"), ("en", None), ("fr", "42")], "lang string, text string")
    model = L.learn(train, 256)
    assert model[0] == ["de", "en"]
    docs = spark.createDataFrame([(1, "the dog", "z"), (2, None, "z"), (3, "", "z"), (4, "1234 !!", "z"),
                                  (5, "der Hund " * 5000, "z"), (1, "the dog", "z"), (None, "THE CAT", "z")],
                                 "doc_id long, text string, lang_pred string")
    got = docs.select("doc_id", L.predictor(spark, model, 256)(F.col("text")).alias("p")).collect()
    assert [(r.doc_id, r.p.lang_pred) for r in got] == [(1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "de"),
                                                       (1, "en"), (None, "en")]
    assert all(0 <= r.p.score <= 1 for r in got) and got[1].p.score == 0


def test_nothing_learned(spark):
    model = L.learn(spark.createDataFrame([], "lang string, text string"))
    docs = spark.createDataFrame([("abc",)], "text string")
    assert docs.select(L.predictor(spark, model)(F.col("text")).alias("p")).first().p.lang_pred == "und"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_held_out_accuracy(spark):
    got = L.op2_language_hd(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    x = got.join(docs, "doc_id").where("held_out")
    assert got.count() == docs.count()
    assert x.where("lang = lang_pred").count() / x.count() >= 0.97
