"""Token-id files: equality with the library, exact round trip, layout."""

import os
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import idfiles as I

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as _f:
    ENC = I.WordEncoder(_f.read())
SF = "/root/testdata/sf0.001"


def lib(t):
    return LIB.encode(t or "", add_special_tokens=False).ids


def ours(t):
    return np.frombuffer(ENC.encode(t), ENC.dtype).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoder_equals_the_library(t):
    assert ours(t) == lib(t)


@pytest.mark.parametrize("t", ["I'll don't 'S 'sx ''s ', 12345 x²", "ΟΔΟΣ ΣΑΣ İx Å ạ́", "<|endoftext|> a <|startoftext|>b",
                               "\x1c\x1d\x85  ​", "՘ \U0001f600\U0001f468‍\U0001f469 日本", " ", "", "a" * 5000])
def test_encoder_cases(t):
    assert ours(t) == lib(t)


def test_random_texts_rich_in_marks_and_apostrophes():
    """100,000 texts in lists, against the library."""
    rnd = random.Random(1)
    marks = [chr(c) for c in range(0x300, 0x11000) if unicodedata.combining(chr(c))]
    plain = [chr(c) for c in range(0x300)] + list("'sstmdrevll  \n") * 8

    def some(i):
        if i % 4 == 0:
            return "".join(rnd.choice(plain) for _ in range(rnd.randint(0, 20)))
        if i % 4 == 1:
            return "".join(rnd.choice(marks if rnd.random() < 0.6 else plain) for _ in range(rnd.randint(1, 8)))
        if i % 4 == 2:
            return "".join(chr(rnd.randrange(0x110000)) for _ in range(6)).encode("utf-8", "ignore").decode()
        return "".join(rnd.choice("'sStTrRvVmMlLdDeE aİ1\"") for _ in range(12))
    for _ in range(50):
        texts = [some(i) for i in range(2000)]
        got = [np.frombuffer(x, ENC.dtype).tolist() for x in ENC.encode_many(texts)]
        assert got == [e.ids for e in LIB.encode_batch(texts, add_special_tokens=False)]


def test_hot_doc_id_spreads_over_files(spark, tmp_path, monkeypatch):
    """One doc_id, and null, with most rows: several files, one order."""
    monkeypatch.setattr(I, "FILE_BYTES", 2000)
    rnd = random.Random(6)
    rows = [(5, f"text number {rnd.randrange(300)} of the hot id") for _ in range(900)]
    rows += [(None, "the same row")] * 300 + [(i, f"doc {i}") for i in range(100)] + [(7, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("file", F.lit("x")).withColumn("ids", F.lit(1))
    I.write_id_files(df.repartition(6), str(tmp_path / "ids"), PATH)
    files = [f for f in os.listdir(tmp_path / "ids") if f.startswith("part") and os.path.getsize(tmp_path / "ids" / f) > 0]
    assert max(os.path.getsize(tmp_path / "ids" / f) for f in files) < 20_000 and len(files) > 8
    got = sorted(I.read_id_files(spark, str(tmp_path / "ids"), with_ids=True).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id is None, r.doc_id or 0, tuple(r.ids)) for r in got) == sorted((d is None, d or 0, (*lib(t), 1)) for d, t in rows)
    at = 0
    for a, b in zip(got, got[1:]):
        assert a.start == at and (-1 if a.doc_id is None else a.doc_id) <= (-1 if b.doc_id is None else b.doc_id)
        at += a.n_tokens


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**26), max_size=400))
def test_block_round_trip(ids):
    ids = np.array([i % (1 + i % 70000) for i in ids], dtype=np.uint32)
    half = len(ids) // 2
    b = I.pack_block(3, [5, None], [half, len(ids) - half], ids) + b"\n"
    (number, n, at, head), = list(I.blocks(b * 1))
    keys, counts, got = I.unpack_block(b, at, head)
    assert (number, n, keys, counts.tolist()) == (3, len(ids), [5, None], [half, len(ids) - half])
    assert got.tolist() == ids.tolist()
    assert len(list(I.blocks(b * 3))) == 3


def test_wide_ranks():
    ids = np.random.default_rng(0).permutation(70_000).astype(np.uint32)
    b = I.pack_block(0, [1], [len(ids)], ids) + b"\n"
    (_, _, at, head), = I.blocks(b)
    assert (I.unpack_block(b, at, head)[2] == ids).all()


def expect(rows):
    out, at = [], 0
    keyed = [(d, np.array([*lib(t), 1], dtype="<u4")) for d, t in rows]
    for d, ids in sorted(keyed, key=lambda r: (r[0] is not None, r[0] or 0, r[1].astype("<u2").tobytes())):
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", 50)
    rnd = random.Random(6)
    rows = [(rnd.randrange(-500, 500), " ".join(rnd.choice(["The", "cat", "don't", "Ñandú", "\n", "x1"]) for _ in range(rnd.randrange(40))))
            for _ in range(200)]
    rows += [(None, "null id"), (None, None), (7, None), (7, ""), (7, "same"), (7, "same"), (9, "long " * 30_000)]
    df = spark.createDataFrame([(*r, 1, "f") for r in rows], "doc_id long, text string, start int, file string").repartition(3)
    I.write_id_files(df, str(tmp_path / "f"), PATH)
    got = I.read_id_files(spark, str(tmp_path / "f"), with_ids=True).collect()
    assert sorted((r.start, str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((s, str(d), n, c) for d, s, n, c in expect(rows))
    assert all(r.ids[-1] == 1 and len(r.ids) == r.n_tokens for r in got)


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    I.write_id_files(df, str(tmp_path / "e"), PATH)
    assert I.read_id_files(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = I.op8_id_files(spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(expect(docs))
