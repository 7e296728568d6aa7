"""Byte-level BPE encoding and decoding with fixed ranks.

Texts are cut into pre-tokens; every distinct pre-token of a chunk of documents
is shuffled to its bucket once, encoded there once per bucket (a word has one
bucket, so once for the whole corpus), and its ids go back to the chunk, where
they are put together by position.  Decoding joins the ids with the token-byte
table, whose size is the vocabulary's.  The shuffles carry packed lists of
distinct words and positions instead of one row per pre-token: a hot word is
one entry per chunk.

The texts are cut twice (once for the words, once for the positions), which
needs less disk than keeping the positions between the steps; chunks carry a
checksum, and a chunk whose answers don't fit raises.

Defined results: a null text counts as empty and has no ids; special tokens'
strings are ordinary text; repeated rows and null ids are encoded row by row;
columns beside the two named ones are not read.
"""

from __future__ import annotations

import base64

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import stash, table
from quire.llm.chunks import (bucket_count, by_chunk, chunks, cut, gathered, join, pack_ids, pack_ints, pack_words, source,
                              unpack_ids, unpack_ints, unpack_words)

ROWS = "chunk string, bucket int, blob binary"


def load_ranks(path: str) -> dict:
    """Token bytes -> rank of a rank file (one base64 token and rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def _splitter(pattern: str):
    import regex
    find = regex.compile(pattern).findall
    return lambda text, raw: [find(text)]


def _batch(rows: list):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["chunk", "bucket", "blob"])


def word_rows(src: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """Distinct pre-tokens of each chunk, bucket by bucket."""
    def run(batches):
        for c in chunks(batches, _splitter(pattern)):
            groups, _ = c.layout(buckets)
            if groups:
                yield _batch([(c.name, b, pack_words(words)) for b, words, _ in groups])
    return src.mapInArrow(run, ROWS)


def sequence_rows(src: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """Document ids, pre-token counts and word numbers of each chunk."""
    def run(batches):
        for c in chunks(batches, _splitter(pattern)):
            _, place = c.layout(buckets)
            blob = join([pack_ids(c.ids), pack_ints(c.counts), pack_ints(place[c.sequence()] if len(place) else []),
                         pack_ints([len(place)])])
            yield _batch([(c.name, -1, blob)])
    return src.mapInArrow(run, ROWS)


def encode_words(rows: DataFrame, ranks, pattern: str) -> DataFrame:
    """Answers the word rows of a bucket: ids of every word, each distinct
    word encoded once."""
    def run(batches):
        import tiktoken
        codec = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})

        class Ids(dict):
            def __missing__(self, w):
                ids = self[w] = np.array(codec.encode_ordinary(w.decode()), dtype="<u4").tobytes()
                return ids

        known = Ids()
        for b in batches:
            for c, k, blob in zip(*(x.to_pylist() for x in b.columns)):
                ids = [known[w] for w in unpack_words(blob)]
                sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
                yield _batch([(c, k, join([pack_ints(sizes), pack_ints(np.frombuffer(b"".join(ids), "<u4"))]))])
    return rows.mapInArrow(run, ROWS)


def _assembled(parts: dict, name: str):
    """doc ids, tokens per document and all ids of a chunk."""
    if -1 not in parts:
        raise RuntimeError(f"chunk {name} was cut differently when it was computed again")
    keys, counts, seq, n = cut(parts.pop(-1))
    keys, counts, seq, n = unpack_ids(keys), unpack_ints(counts), unpack_ints(seq), int(unpack_ints(n)[0])
    sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in sorted(parts):
        s, f = cut(parts[k])
        sizes.append(unpack_ints(s)), flat.append(unpack_ints(f))
    size, ids = np.concatenate(sizes), np.concatenate(flat).astype("<u4")
    if len(size) != n:
        raise RuntimeError(f"chunk {name} was cut differently when it was computed again")
    per = size[seq]                                    # ids of each pre-token, by position
    ends = np.cumsum(per)
    start = (np.cumsum(size) - size)[seq]
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(start - (ends - per), per) + np.arange(total)
    cuts = np.concatenate(([0], np.cumsum(counts)))
    edge = np.concatenate(([0], ends))[cuts]           # documents' edges in the ids
    return keys, edge, ids[at]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
                  with_ids: bool = False, stored: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]`` per row.
    ``stored``: the rows are read straight from files, so computing them again
    gives them in the same order; other rows are stored first."""
    import pyarrow as pa
    spark = docs.sparkSession
    table_ = load_ranks(ranks_path)                    # fixed vocabulary file
    ranks = spark.sparkContext.broadcast(table_)
    docs = docs.select(key, text) if stored else stash(docs.select(key, text), "texts")
    src = source(docs, key, text)
    buckets = bucket_count(src, "text")
    words = word_rows(src, pattern, buckets).repartitionById(buckets, F.col("bucket"))
    answers = encode_words(words, ranks, pattern)
    both = gathered(answers.unionByName(sequence_rows(src, pattern, buckets)), buckets)
    kind = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
                      *([("ids", pa.list_(pa.int64()))] if with_ids else [])])

    def run(batches):
        from hashlib import sha256
        names = {r: t for t, r in ranks.value.items()}
        for name, parts in by_chunk(batches):
            keys, edge, ids = _assembled(parts, name)
            rows = []
            for d, s, e in zip(keys, edge[:-1].tolist(), edge[1:].tolist()):
                one = ids[s:e]
                decoded = b"".join(map(names.__getitem__, one.tolist()))
                rows.append((d, e - s, sha256(one.tobytes()).hexdigest(), sha256(decoded).hexdigest(), one))
            cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows])]
            if with_ids:
                cols.append(pa.array([r[4].astype(np.int64) for r in rows], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, schema=kind)

    ddl = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<bigint>" if with_ids else "")
    return both.mapInArrow(run, ddl)


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return encode_decode(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, stored=True)
