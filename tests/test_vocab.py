"""Whitespace vocabulary and encoding (broadcast and salted join paths)."""

import collections

from quire.operators import vocab as V


TEXTS = ["the cat the dog", "a dog and the cat", "", "zebra", "the the the"]


def test_vocab_and_encode_paths(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    voc = V.whitespace_vocab(df)
    cnt = collections.Counter(w for t in TEXTS for w in t.split())
    exp = {w: i for i, (w, _) in enumerate(sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0])))}
    got = {r.token: r.id for r in voc.collect()}
    assert got == exp
    want = {i: [exp[w] for w in t.split()] for i, t in enumerate(TEXTS)}
    a = {r.doc_id: list(r.input_ids) for r in V.encode(df, voc).collect()}
    monkeypatch.setattr(V, "BROADCAST_VOCAB_ROWS", 0)          # force the salted shuffle join
    b = {r.doc_id: list(r.input_ids) for r in V.encode(df, voc).collect()}
    assert a == want and b == want


def test_encode_meets_the_vocabulary_once_per_chunk(spark, monkeypatch):
    """Distinct words of a chunk, not tokens, are joined; repeated and null keys
    become one row by position, unknown words ``unk_id``."""
    rows = [(1, "a b a", "x"), (2, None, "x"), (3, "  ", "y"), (None, "b c", "y"), (None, "a", "y"), (4, "a " * 500, "x"), (5, "q a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, split string").coalesce(1)
    voc = spark.createDataFrame([("a", 0, 9), ("b", 1, 5), ("c", 2, 1)], "token string, id long, freq long")
    seen, plain = [], V._join_vocab
    monkeypatch.setattr(V, "_join_vocab", lambda w, v: seen.append(w.count()) or plain(w, v))
    got = {(r.doc_id, r.split): list(r.input_ids) for r in V.encode(df, voc, keep=["split"]).collect()}
    assert got == {(1, "x"): [0, 1, 0], (2, "x"): [], (3, "y"): [], (None, "y"): [0, 1, 2], (4, "x"): [0] * 500, (5, "x"): [-1, 0]}
    assert seen == [4]
    monkeypatch.setattr(V, "CHUNK", 1)
    many = spark.createDataFrame([(i, f"w{i % 7} w{i % 3} a") for i in range(600)], "doc_id long, text string")
    voc = V.whitespace_vocab(many)
    at = {r.token: r.id for r in voc.collect()}
    got = {r.doc_id: list(r.input_ids) for r in V.encode(many, voc).collect()}
    assert got == {i: [at[f"w{i % 7}"], at[f"w{i % 3}"], at["a"]] for i in range(600)}
