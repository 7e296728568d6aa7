"""Byte-level BPE: equality with the library and exact round trip."""

import os
import random
from hashlib import sha256

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from quire.llm import bytebpe as B, chunks as C

PATH = P.path("byte_bpe_50k.tiktoken")
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.load_ranks(PATH), special_tokens={})
SF = "/root/testdata/sf0.001"


def expect(t):
    ids = np.array(LIB.encode_ordinary(t or ""), dtype="<u4")
    return len(ids), sha256(ids.tobytes()).hexdigest(), sha256((t or "").encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdlm")), max_size=80))
def test_words_one_by_one_equal_the_whole_text(t):
    words = B._splitter(P.PATTERN)(t, b"")[0]
    assert "".join(words) == t
    assert [i for w in words for i in LIB.encode_ordinary(w)] == LIB.encode_ordinary(t)


def test_packing():
    rnd = np.random.default_rng(0)
    for a in ([], [0], [5, 0, 300], rnd.integers(0, 1 << 50, 1000), np.arange(100_000)):
        assert C.unpack_ints(C.pack_ints(a)).tolist() == list(a)
        assert C.unpack_sorted(C.pack_sorted(np.sort(a))).tolist() == sorted(a)
    for w in ([b"a"], [b""], [b"x", b"", b"y\n"] * 50):
        assert C.unpack_words(C.pack_words(w)) == w
    assert C.unpack_ids(C.pack_ids([None, -5, 1 << 62])) == [None, -5, 1 << 62]


@pytest.mark.parametrize("limit", [1, 2000, C.CHUNK])
def test_matches_the_library(spark, monkeypatch, limit):
    monkeypatch.setattr(C, "CHUNK", limit)
    rnd = random.Random(8)
    rows = [(i, "".join(rnd.choice(["The ", "cat", "'s ", "\n\n", " 42", "ñandú ", "日本", "!? ", "<|endoftext|>"]) for _ in range(rnd.randrange(80))))
            for i in range(60)]
    rows += [(900, None), (901, ""), (902, "   "), (None, "null id"), (3, "again"), (3, "again"), (903, "long text " * 20_000)]
    df = spark.createDataFrame([(*r, b"x", "c") for r in rows], "doc_id long, text string, blob binary, chunk string").repartition(3, "doc_id")
    got = B.encode_decode(df, PATH, P.PATTERN, with_ids=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((str(d), *expect(t)) for d, t in rows)
    assert all(len(r.ids) == r.n_tokens for r in got)


def test_empty(spark):
    assert B.encode_decode(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN).count() == 0


def test_chunks_cut_differently_raise():
    c = C.Chunk(0, 0)
    c.add(1, b"a b", [["a", " b"]])
    with pytest.raises(RuntimeError):
        B._assembled({0: C.join([C.pack_ints([1]), C.pack_ints([5])])}, c.name)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = B.op3_byte_bpe(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((r.doc_id, *expect(r.text)) for r in docs)
