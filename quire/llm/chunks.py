"""Chunks of documents and their distinct words.

Operators that need a corpus-wide fact about every word (its token ids, its
count) send each *distinct* word of a chunk of documents to the word's bucket
once, get the answer back to the chunk, and put the tokens together again by
position.  A word that makes up a third of all tokens is then one entry per
chunk.  Rows between the steps carry whole lists (one row per chunk and
bucket) as compressed bytes.

A chunk's words are numbered bucket by bucket, in order inside a bucket, so
the answers of the buckets, in order, are the answers for words 0, 1, 2, ...
The chunk's name holds a checksum of its texts: when a step is computed again
and cuts other chunks, the answers find no partner and the step raises.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

CHUNK = 8 << 20              # text bytes per chunk, about (whole documents)
BUCKET = 64 << 20            # text bytes per bucket, about
SEP = b"\xff"                # occurs in no UTF-8 text


def pack(data: bytes) -> bytes:
    """Zstandard, or the bytes as they are when short."""
    import zstandard
    return b"\0" + data if len(data) < 64 else b"\1" + zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> bytes:
    import zstandard
    return data[1:] if data[:1] == b"\0" else zstandard.ZstdDecompressor().decompress(data[1:])


def join(parts: list) -> bytes:
    return b"".join(struct.pack("<Q", len(p)) + p for p in parts)


def cut(data: bytes) -> list:
    out, at = [], 0
    while at < len(data):
        n, = struct.unpack_from("<Q", data, at)
        out.append(data[at + 8:at + 8 + n])
        at += 8 + n
    return out


def pack_ints(a) -> bytes:
    """Non-negative integers as compressed byte planes."""
    a = np.asarray(a).astype("<u8")
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    planes = a.view(np.uint8).reshape(-1, 8)[:, :width]
    return struct.pack("<B", width) + pack(np.ascontiguousarray(planes.T).tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    width, raw = data[0], np.frombuffer(unpack(data[1:]), dtype=np.uint8)
    out = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    out[:, :width] = raw.reshape(width, -1).T
    return out.view("<u8").ravel().astype(np.int64)


def pack_sorted(a) -> bytes:
    a = np.asarray(a, dtype=np.int64)
    return pack_ints(np.diff(a, prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(data))


def pack_ids(ids: list) -> bytes:
    """Nullable 64-bit ids."""
    return join([np.array([i is None for i in ids], dtype=np.uint8).tobytes(),
                 np.array([0 if i is None else i for i in ids], dtype="<i8").tobytes()])


def unpack_ids(data: bytes) -> list:
    null, ids = cut(data)
    return [None if z else int(i) for z, i in zip(np.frombuffer(null, np.uint8), np.frombuffer(ids, "<i8"))]


def pack_words(words: list) -> bytes:
    return pack(SEP.join(words))


def unpack_words(data: bytes) -> list:
    return unpack(data).split(SEP)


class Numbers(dict):
    """word -> number in order of appearance."""

    def __missing__(self, w):
        n = self[w] = len(self)
        return n


class Chunk:
    """Consecutive documents of one task: ids, tokens per document, tokens."""

    def __init__(self, split: int, at: int):
        self.split, self.at, self.crc, self.bytes = split, at, 0, 0
        self.ids: list = []
        self.flags: list = []
        self.counts: list = []
        self.tokens: list = []
        self.numbers = Numbers()

    @property
    def name(self) -> str:
        return f"{self.split}/{self.at}/{self.crc:08x}"

    def add(self, key, text: bytes, words, flag=False):
        """``words``: lists of words, in order."""
        self.crc = zlib.crc32(text, zlib.crc32(str(key).encode(), self.crc))
        self.bytes += len(text) + 16
        n = 0
        for w in words:
            self.tokens.append(np.fromiter(map(self.numbers.__getitem__, w), dtype=np.int32, count=len(w)))
            n += len(w)
        self.ids.append(key), self.flags.append(flag), self.counts.append(n)

    def sequence(self) -> np.ndarray:
        return np.concatenate(self.tokens) if self.tokens else np.zeros(0, dtype=np.int32)

    def layout(self, buckets: int):
        """Words per bucket (bucket, sorted words) and, for every number of
        appearance, the word's place in that order."""
        names = [w if isinstance(w, bytes) else w.encode() for w in self.numbers]
        b = np.fromiter(map(zlib.crc32, names), dtype=np.int64, count=len(names)) % buckets
        by = sorted(range(len(names)), key=lambda i: (b[i], names[i]))
        place = np.empty(len(names), dtype=np.int64)
        place[by] = np.arange(len(names))
        groups = []
        edges = np.flatnonzero(np.diff(b[by], prepend=-1, append=-1)) if by else []
        for s, e in zip(edges[:-1], edges[1:]):
            groups.append((int(b[by[s]]), [names[i] for i in by[s:e]], np.array(by[s:e])))
        return groups, place


def source(docs: DataFrame, key: str, text: str, flag=None) -> DataFrame:
    """``id, text, split[, flag]`` of rows read straight from files; ``split``
    names the piece of the file a row comes from."""
    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"),
                       F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("split"),
                       *([flag.alias("flag")] if flag is not None else []))


def chunks(batches, split, limit: int = None):
    """Chunks of the rows of :func:`source` in Arrow batches; ``split`` gives
    the word lists of a text (str, '' for null).  A chunk holds rows of one
    piece of a file, so its name is the same wherever it is computed."""
    limit = CHUNK if limit is None else limit
    c = None
    for b in batches:
        for s in range(0, b.num_rows, 256):
            rows = [x.to_pylist() for x in b.slice(s, 256).columns]
            flags = rows[3] if len(rows) > 3 else [False] * len(rows[0])
            for key, text, piece, flag in zip(*rows[:3], flags):
                raw = (text or "").encode()
                if c is None or piece != c.split or c.bytes + len(raw) > limit and c.ids:
                    if c is not None:
                        yield c
                    c = Chunk(piece, c.at + 1 if c is not None and piece == c.split else 0)
                c.add(key, raw, split(text or "", raw), flag)
    if c is not None:
        yield c


def bucket_count(docs: DataFrame, text: str, size_of: int = BUCKET) -> int:
    """Buckets for the corpus: never fewer than shuffle partitions."""
    size = docs.select(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size // size_of + 1))


def by_chunk(batches):
    """(chunk, {bucket: blob}) groups of rows (chunk, bucket, blob) that are
    sorted by chunk and bucket."""
    name, held = None, {}
    for b in batches:
        for c, k, blob in zip(*(x.to_pylist() for x in b.columns)):
            if c != name:
                if held:
                    yield name, held
                name, held = c, {}
            held[k] = blob
    if held:
        yield name, held


def gathered(rows: DataFrame, parts: int) -> DataFrame:
    """All rows (chunk, bucket, blob) of a chunk in one task, bucket by bucket."""
    return rows.repartition(parts, "chunk").sortWithinPartitions("chunk", "bucket").select("chunk", "bucket", "blob")
