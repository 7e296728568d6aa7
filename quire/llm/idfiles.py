"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Texts are encoded with a fixed tokenizer; documents go to files in ascending
doc_id order (range boundaries from quantiles or a sample, one file per range,
one shuffle of ids).  A file is a run of self-contained blocks:

    header   magic, file number, documents, ranks, ids, data bytes
    docs     doc_id (int64), null flag (uint8), id count (uint32)
    ranks    the block's distinct ids, most frequent first (uint32)
    control  one byte per four ids: 2 bits each, bytes of the rank less one
    data     the ranks, little-endian, 1 to 4 bytes each
    newline

Ranks are counted over all ids of the block, so the 256 most frequent ids take
one byte of data.  The control bytes are apart from the data and are decoded
by one numpy table lookup that gives four lengths per byte.  Spark's text
writer puts the blocks into files (task commit, retries, any file system).

Memory: a block holds ``BLOCK`` ids or one document.  The only thing collected
is one total per file.

Defined results: a null text counts as empty (its only id is the end id); null
doc_ids come first; rows that share a doc_id stay together, ordered by their
ids; if they fill several files, those are cut by the first ``HEAD_IDS`` bytes
of ids and equal rows spread over them; an empty table writes no block.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import scratch, table
from quire.operators.order import range_bounds

MAGIC = b"QID1"
HEAD = "<4sIIIQQ"
BLOCK = 1 << 20              # ids in a block, about
FILE_BYTES = 64 << 20        # text bytes per file, about
STEP = 1 << 20               # text bytes encoded at a time, about
SAMPLE = 40                  # rows a file that bounds are taken from
HEAD_IDS = 256               # bytes of ids that place a row among the files
# control byte -> lengths of its four values
LENGTHS = np.array([[(c >> (2 * j) & 3) + 1 for j in range(4)] for c in range(256)], dtype=np.uint8)


class WordEncoder(dict):
    """word -> its ids, for tokenizers whose words are encoded one by one:
    NFC, lower case, split into words, byte-level BPE per word.

    Many texts are cut into words at once: character classes in numpy, equal
    words found by Arrow's dictionary, each distinct word encoded once.  This
    holds for texts of characters below ``PLAIN``, where NFC changes nothing.
    Other texts are normalised by the library and cut by the split pattern;
    those with a character that this Python's Unicode tables don't know, or
    with a special token's string, go through the library as a whole."""

    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"      # the file's own split pattern
    LIMIT = 400_000
    PLAIN = 0x300            # below the first combining mark
    LETTER, NUMBER, OTHER = 1, 2, 3

    def __init__(self, text: str):
        import regex
        from tokenizers import Tokenizer
        super().__init__()
        self.tok = Tokenizer.from_str(text)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        conf = json.loads(text)
        self.special = [t["content"] for t in conf["added_tokens"]]
        if conf["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != self.SPLIT:
            raise ValueError("the tokenizer splits words by another pattern")
        self.find = regex.compile(self.SPLIT).findall
        self.rare = regex.compile("[͸-\U0010ffff]").search      # no unassigned character lies below
        self.hard = re.compile(f"[^\0-{chr(self.PLAIN - 1)}]").search
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]      # bytes the byte-level alphabet keeps
        rest = [b for b in range(256) if b not in plain]
        self.letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        # classes of the characters that lower-cased plain text can hold
        small = sorted({ord(c) for i in range(self.PLAIN) for c in chr(i).lower()})
        self.kind = np.zeros(small[-1] + 1, dtype=np.uint8)
        for i in small:
            c = chr(i)
            self.kind[i] = (self.LETTER if regex.match(r"\p{L}", c) else self.NUMBER if regex.match(r"\p{N}", c)
                            else 0 if regex.match(r"\s", c) else self.OTHER)

    def __missing__(self, word: bytes):
        if len(self) >= self.LIMIT:
            self.clear()
        ids = [t.id for t in self.tok.model.tokenize("".join(map(self.letter.__getitem__, word)))]
        out = self[word] = np.array(ids, dtype=self.dtype)
        return out

    def encode(self, text) -> bytes:
        """One text, cut by the pattern itself."""
        if not text:
            return b""
        odd = not text.isascii() and self.rare(text) and any(unicodedata.category(c) == "Cn" for c in set(text))
        if odd or any(s in text for s in self.special):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        if not text.isascii():
            text = self.tok.normalizer.normalize_str(text)      # also lower-cases
        return b"".join([self[w.encode()].tobytes() for w in self.find(text.lower() if text.isascii() else text)])

    def cuts(self, cp: np.ndarray) -> np.ndarray:
        """Where words (and runs of white space) begin."""
        kind = self.kind[cp]
        begin = np.ones(len(cp), dtype=bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == self.NUMBER)
        at = np.flatnonzero((cp == 39) & begin)                  # an apostrophe inside a run is part of the run
        if len(at):
            one = np.concatenate([cp, [0, 0, 0]])
            a, b = one[at + 1], one[at + 2]
            short = np.isin(a, [ord(c) for c in "stmd"])
            long_ = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            begin[at[short | long_] + 1] = False
            for ends in (at[short] + 2, at[long_] + 3):
                begin[ends[ends < len(cp)]] = True
        return np.flatnonzero(begin)

    def encode_many(self, texts: list) -> list:
        """Ids of every text as bytes."""
        import pyarrow as pa
        out, easy = [b""] * len(texts), []
        for i, t in enumerate(texts):
            if t and (self.hard(t) or any(s in t for s in self.special)):
                out[i] = self.encode(t)
            elif t:
                easy.append(i)
        if not easy:
            return out
        small = [texts[i].lower() for i in easy]
        joined = "\n".join(small) + "\n"
        cp = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        begin = self.cuts(cp)
        data = joined.encode()
        if len(data) == len(cp):
            place = begin
        else:
            width = 1 + (cp >= 0x80).astype(np.int8) + (cp >= 0x800)
            place = (np.cumsum(width, dtype=np.int64) - width)[begin]
        offsets = np.append(place, len(data)).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        names, which = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        ids = [self[w] for w in names]
        lens = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat, base = np.concatenate(ids), np.cumsum(lens) - lens
        n = np.where(self.kind[cp[begin]] == 0, 0, lens[which])
        ends = np.cumsum(n)
        got = flat[np.repeat(base[which] - (ends - n), n) + np.arange(ends[-1])].tobytes()
        chars = np.cumsum([len(t) + 1 for t in small])           # the separator is white space, so it ends a word
        upto = np.concatenate(([0], ends))[np.searchsorted(begin, chars)] * self.dtype.itemsize
        for i, s, e in zip(easy, [0, *upto[:-1].tolist()], upto.tolist()):
            out[i] = got[s:e]
        return out


def pack_block(number: int, doc_ids: list, counts: list, ids: np.ndarray) -> bytes:
    n = len(ids)
    top = int(ids.max()) + 1 if n else 0
    freq = np.bincount(ids, minlength=top)
    names = np.flatnonzero(freq)
    names = names[np.argsort(-freq[names], kind="stable")]
    rank = np.zeros(top, dtype=np.uint32)
    rank[names] = np.arange(len(names), dtype=np.uint32)
    v = rank[ids]
    size = 1 + (v >= 1 << 8).astype(np.uint8) + (v >= 1 << 16) + (v >= 1 << 24)
    ends = np.cumsum(size, dtype=np.int64)
    data = np.zeros(int(ends[-1]) if n else 0, dtype=np.uint8)
    at = ends - size
    for k in range(4):
        more = size > k
        if not more.any():
            break
        data[at[more] + k] = v[more] >> (8 * k) & 255
    code = np.zeros(-(-n // 4) * 4, dtype=np.uint8)
    code[:n] = size - 1
    c = code.reshape(-1, 4)
    control = c[:, 0] | c[:, 1] << 2 | c[:, 2] << 4 | c[:, 3] << 6
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    keys = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    return b"".join([struct.pack(HEAD, MAGIC, number, len(doc_ids), len(names), n, len(data)), keys.tobytes(), null.tobytes(),
                     np.array(counts, dtype="<u4").tobytes(), names.astype("<u4").tobytes(), control.tobytes(), data.tobytes()])


def blocks(buf):
    """(file number, ids in the block, offset of its body, header) of each block."""
    at = 0
    while at < len(buf):
        magic, number, docs, ranks, n, data = struct.unpack_from(HEAD, buf, at)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        yield number, n, at + struct.calcsize(HEAD), (docs, ranks, n, data)
        at += struct.calcsize(HEAD) + 13 * docs + 4 * ranks + (n + 3) // 4 + data + 1


def unpack_block(buf, at: int, head):
    """doc_ids, counts and ids (uint32) of one block."""
    docs, ranks, n, data = head

    def take(dtype, m):
        nonlocal at
        x = np.frombuffer(buf, dtype, m, at)
        at += x.nbytes
        return x
    keys, null, counts, names = take("<i8", docs), take("u1", docs), take("<u4", docs), take("<u4", ranks)
    size = LENGTHS[take("u1", (n + 3) // 4)].ravel()[:n]
    body = take("u1", data)
    start = np.cumsum(size, dtype=np.int64) - size
    v = body[start].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        v[more] |= body[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return [None if z else int(d) for d, z in zip(keys, null)], counts, names[v]


def encoded(rows: DataFrame, tokenizer: str, end_id: int, bounds: list, head: int | None = None) -> DataFrame:
    """``file, doc_id, spread, ids, width`` of ``doc_id, text, spread`` rows;
    ids as little-endian bytes of that width (only their first ``head`` bytes
    if given).  The file is the number of bounds not after the row."""
    from bisect import bisect_right

    import pyarrow as pa
    with open(tokenizer, encoding="utf-8") as f:           # a fixed file of about 2 MB
        shared = rows.sparkSession.sparkContext.broadcast((f.read(), bounds))

    def run(batches):
        text, bounds = shared.value
        enc = WordEncoder(text)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for b in batches:
            for s, e in slices(b.column(1)):
                part = b.slice(s, e - s)
                ids = [x + end for x in enc.encode_many(part.column(1).to_pylist())]
                file = [bisect_right(bounds, place(d, x, k)) for d, x, k in zip(part.column(0).to_pylist(), ids, part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(file, pa.int32()), part.column(0), part.column(2),
                                                  pa.array([x[:head] for x in ids], pa.binary()), pa.array([enc.dtype.itemsize] * len(ids), pa.int32())],
                                                 names=["file", "doc_id", "spread", "ids", "width"])

    return rows.mapInArrow(run, "file int, doc_id bigint, spread bigint, ids binary, width int")


def place(doc_id, ids: bytes, spread: int) -> tuple:
    """A row's place in the order of the files; nulls come first."""
    return -(1 << 64) if doc_id is None else doc_id, ids[:HEAD_IDS], spread


def file_bounds(rows: DataFrame, tokenizer: str, end_id: int, files: int) -> list:
    """Where files begin: quantiles of the doc_ids or, when ids fill more than
    a file, places of a bounded sample of rows (``SAMPLE`` a file)."""
    bounds = range_bounds(rows.select("doc_id"), ["doc_id"], files)
    if len(bounds) == files - 1:
        return bounds
    n = rows.count()
    if not n:
        return []
    some = rows.sample(False, min(1.0, 2.0 * SAMPLE * files / n), seed=7)
    got = encoded(some, tokenizer, end_id, [], HEAD_IDS).limit(4 * SAMPLE * files).collect()
    keys = sorted(place(r.doc_id, bytes(r.ids), r.spread) for r in got)
    return sorted({keys[len(keys) * i // files] for i in range(1, files)}) if keys else []


def slices(texts, step: int = STEP):
    """Row ranges of an Arrow text column of about ``step`` bytes each."""
    import pyarrow.compute as pc
    size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // step
    edges = np.flatnonzero(np.diff(part, prepend=-1)).tolist() + [len(size)]
    return zip(edges[:-1], edges[1:])


def write_id_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> None:
    import pyarrow as pa
    spark = docs.sparkSession
    x = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")) \
            .withColumn("spread", F.monotonically_increasing_id())
    size = x.select(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // FILE_BYTES + 1))
    rows = encoded(x, tokenizer, end_id, file_bounds(x, tokenizer, end_id, files))
    rows = rows.repartitionById(files, F.col("file")).sortWithinPartitions("doc_id", "ids").select("file", "doc_id", "ids", "width")

    def run(batches):
        number, keys, counts, parts, held = 0, [], [], [], 0
        for b in batches:
            for f, d, x, w in zip(*(c.to_pylist() for c in b.columns)):
                a = np.frombuffer(x, f"<u{w}")
                if held and held + len(a) > BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array([pack_block(number, keys, counts, np.concatenate(parts))], pa.binary())], names=["b"])
                    keys, counts, parts, held = [], [], [], 0
                number = f
                keys.append(d), counts.append(len(a)), parts.append(a)
                held += len(a)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([pack_block(number, keys, counts, np.concatenate(parts))], pa.binary())], names=["b"])

    rows.mapInArrow(run, "b binary").select(F.col("b").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_id_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32[, ids]`` from the files alone."""
    import pyarrow as pa
    files = spark.read.format("binaryFile").load(path).select("content")

    def sizes(batches):
        for b in batches:
            for content in b.column(0):
                got = [(number, n) for number, n, _, _ in blocks(content.as_buffer())]
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.int64())],
                                                 names=["file", "n"])

    per = files.mapInArrow(sizes, "file int, n bigint").groupBy("file").agg(F.sum("n").alias("n")).collect()      # one row per file
    base, at = {}, 0
    for r in sorted(per, key=lambda r: r["file"]):
        base[r["file"]] = at
        at += r.n
    kind = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                      *([("ids", pa.list_(pa.int64()))] if with_ids else [])])

    def run(batches):
        for b in batches:
            for content in b.column(0):
                buf, done = content.as_buffer(), 0
                for number, n, body, head in blocks(buf):
                    keys, counts, ids = unpack_block(buf, body, head)
                    ends = np.cumsum(counts, dtype=np.int64)
                    starts = ends - counts
                    raw = memoryview(np.ascontiguousarray(ids.astype("<u4"))).cast("B")
                    crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                    cols = [pa.array(keys, pa.int64()), pa.array(starts + (base[number] + done)), pa.array(counts.astype(np.int64)),
                            pa.array(crc, pa.int64())]
                    if with_ids:
                        cols.append(pa.array([ids[s:e].astype(np.int64) for s, e in zip(starts, ends)], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(cols, schema=kind)
                    done += n

    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    return files.mapInArrow(run, ddl)


def op8_id_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch(spark, "ids")
    write_id_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_id_files(spark, path)
