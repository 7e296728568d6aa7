"""WARC archives: round trip, revisits, frame layout."""

import glob
import hashlib
import os
import random
import struct

import pytest

from quire.llm import warczst as W

SF = "/root/testdata/sf0.001"


def rows():
    rnd = random.Random(1)
    big = "x" * 1000
    out = [(i, f"http://h{i}.org/a b?\n", f"<p>{rnd.random()}</p>" * rnd.randrange(60)) for i in range(120)]
    out += [(500, "u", big), (501, "u", big), (502, None, big), (503, "u", big[:-1]), (504, "u", big[:-1]),
            (505, "u", None), (506, "u", ""), (507, "u", "é" * 500), (508, "u", "é" * 500), (508, "u", "é" * 500),
            (None, "u", "z" * 2000), (None, "u", "z" * 2000), (None, "u", big),
            (600, "u", "\r\n\r\nWARC/1.1\r\n" * 100 + W.GAP.decode()), (601, "u", os.urandom(3000).hex() + " ")]
    return out


def expect(rs):
    keep, n = {}, {}
    for i, _, h in rs:
        p = (h or "").encode()
        n[p] = n.get(p, 0) + 1
        keep[p] = max(keep.get(p, -1), -1 if i is None else i)
    out = []
    for i, u, h in rs:
        p = (h or "").encode()
        rev = len(p) >= 1000 and n[p] > 1 and keep[p] >= 0 and i != keep[p]
        out.append((str(i), len(p), hashlib.sha1(p).hexdigest(), "revisit" if rev else "response",
                    keep[p] if rev else None, None if rev else p))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    rs = rows()
    df = spark.createDataFrame([(*r, "c") for r in rs], "page_id long, url string, html string, payload string").repartition(3)
    W.write_archives(df, str(tmp_path / "a"))
    got = W.read_archives(spark, str(tmp_path / "a")).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got), key=str) == expect(rs)
    for f in glob.glob(str(tmp_path / "a" / "part-*")):
        data = open(f, "rb").read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == W.DICT_MAGIC and 8 < size <= W.DICT_BYTES


def test_incompressible_payload_may_hold_the_separator():
    import zstandard
    body = os.urandom(500) + W.GAP + os.urandom(500)
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(body)
    assert W.GAP in frame and W.frame_end(frame + b"rest", 0) == len(frame)


def test_empty_table_and_tiny_sample(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string")
    W.write_archives(df, str(tmp_path / "one"))
    assert [r.payload for r in W.read_archives(spark, str(tmp_path / "one")).collect()] == [b"a"]
    W.write_archives(df.limit(0), str(tmp_path / "none"))
    assert W.read_archives(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_query_covers_the_table_and_compresses(spark):
    got = W.op5_warc_dictionary(spark, SF)
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert sorted((r.page_id, r.payload_digest) for r in got.collect()) == \
        sorted((p.page_id, hashlib.sha1(p.html.encode()).hexdigest()) for p in pages)
