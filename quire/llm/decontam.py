"""Benchmark decontamination: SimHash of item-sized windows.

Every benchmark item of n words is compared with the n-word windows of every
document.  Windows that hold no word shingle of any item have similarity zero
to all of them and are never fingerprinted; every other window gets a 64-bit
SimHash of its shingles (sliding sums, no rehashing).  Items are indexed by
the eight bytes of their fingerprints: two fingerprints at most ``RADIUS`` =
23 apart differ by at most two bits in some byte, so probing each byte's
two-bit neighbourhood yields every item within the radius; the Hamming
distance is then checked, and what remains is verified by the exact weighted
Jaccard similarity of the shingle multisets (weight = occurrences).

A window of similarity 0.8 differs from its item in 10 fingerprint bits on
average, with a standard deviation of 3, so the radius passes it over with a
probability below one in 100,000.

Documents are read once per part of the benchmark, without a shuffle.  A part
holds about ``PART_BYTES`` of item texts and is broadcast; a larger benchmark
is dealt into more parts, all of which are searched.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, texts
are read whole; null texts have no words; an item of fewer than ``shingle``
words only matches a document of exactly its words, one without words matches
nothing; a document shorter than an item is one window; repeated items and
repeated rows give repeated results once per row.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import payloads, table

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23                  # eight bytes, two bits each
PART_BYTES = 4 << 20         # item texts searched together
PIECE = 1 << 15              # windows fingerprinted together

_NEAR = [np.flatnonzero(np.bitwise_count(np.arange(256, dtype=np.uint8) ^ np.uint8(v)) <= 2) for v in range(256)]
_POW = np.array([pow(0x9E3779B97F4A7C15, j, 1 << 64) | 1 for j in range(1, 65)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit codes of the k-word runs of a sequence of word hashes."""
    m = len(h) - k + 1
    if m < 1:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        out += h[j:j + m] * _POW[j]
    return mix(out)


def word_hashes(words: list) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def sliding_fingerprints(codes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of ``codes[s:s + width]`` for each of the sorted ``starts``."""
    lo = starts[0]
    part = codes[lo:starts[-1] + width]
    bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(part) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=total[1:])
    ones = total[starts - lo + width] - total[starts - lo]
    return np.packbits(ones * 2 > width, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: Counter, b: Counter) -> float:
    inter = sum(min(c, b[s]) for s, c in a.items() if s in b)
    return inter / (sum(a.values()) + sum(b.values()) - inter)


class Items:
    """Search structure over a bounded part of the benchmark."""

    def __init__(self, rows, k: int = SHINGLE, threshold: float = THRESHOLD, radius: int = RADIUS):
        if radius > RADIUS:
            raise ValueError(f"the index guarantees a radius of {RADIUS} bits")
        self.k, self.threshold, self.radius = k, threshold, radius
        self.whole: dict = {}                  # short items by their words
        self.items: list = []                  # (item_id, n, shingle multiset, fingerprint)
        self.sizes: dict = {}                  # n -> items of n words
        vocab, codes = set(), {}
        for item_id, text in rows:
            words = (text or b"").lower().split()
            if not words:
                continue
            if len(words) < k:
                self.whole.setdefault(tuple(words), []).append(item_id)
                continue
            c = shingles(word_hashes(words), k)
            fp = sliding_fingerprints(c, np.array([0]), len(c))[0]
            self.sizes.setdefault(len(words), []).append(len(self.items))
            for x in c.tolist():
                codes.setdefault(x, set()).add(len(words))
            self.items.append((item_id, len(words), Counter(c.tolist()), fp))
            vocab.update(words)
        self.vocab = {w: h for w, h in zip(vocab, word_hashes(list(vocab)).tolist())}
        self.codes = np.array(sorted(codes), dtype=np.uint64)
        self.lengths = [sorted(codes[c]) for c in sorted(codes)]       # item lengths a shingle occurs in
        # byte position and value -> items whose byte is within two bits, per length
        self.index = {n: [self._bucket(at, j) for j in range(8)] for n, at in self.sizes.items()}

    def _bucket(self, at: list, j: int) -> list:
        table: list = [[] for _ in range(256)]
        for i in at:
            for v in _NEAR[int(self.items[i][3]) >> (8 * j) & 255]:
                table[v].append(i)
        return [np.array(t, dtype=np.int64) for t in table]

    def within(self, fps: np.ndarray, n: int):
        """Pairs (window, item) of ``n`` words within the radius."""
        by = fps.astype("<u8").view(np.uint8).reshape(-1, 8)
        cand = []
        for j in range(8):
            for v in np.unique(by[:, j]):
                at = np.flatnonzero(by[:, j] == v)
                hit = self.index[n][j][v]
                if len(hit):
                    cand.append(np.stack([np.repeat(at, len(hit)), np.tile(hit, len(at))]))
        if not cand:
            return
        pairs = np.unique(np.concatenate(cand, axis=1), axis=1)
        fp = np.array([self.items[i][3] for i in pairs[1]], dtype=np.uint64)
        d = np.bitwise_count(fps[pairs[0]] ^ fp)
        for (w, i), x in zip(pairs[:, d <= self.radius].T.tolist(), d[d <= self.radius].tolist()):
            yield w, i, x

    def _hits(self, words: list):
        """Positions of benchmark shingles and their row in ``codes``."""
        get, k = self.vocab.__getitem__, self.k
        known = np.fromiter(map(self.vocab.__contains__, words), dtype=bool, count=len(words))
        run = np.convolve(known, np.ones(k, dtype=np.int64), "valid") if len(words) >= k else np.zeros(0)
        at = np.flatnonzero(run == k)
        if not len(at):
            return at, at
        need = np.unique((at[:, None] + np.arange(k)).ravel())
        h = np.zeros(len(words), dtype=np.uint64)
        h[need] = np.fromiter((get(words[i]) for i in need.tolist()), dtype=np.uint64, count=len(need))
        code = np.zeros(len(at), dtype=np.uint64)
        for j in range(k):
            code += h[at + j] * _POW[j]
        code = mix(code)
        row = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        ok = self.codes[row] == code
        return at[ok], row[ok]

    def search(self, text) -> list:
        """Best match per item: (item_id, start word, words, distance, similarity)."""
        words = (text or b"").lower().split()
        n_words = len(words)
        out = []
        if 0 < n_words < self.k:
            return [(i, 0, n_words, 0, 1.0) for i in self.whole.get(tuple(words), [])]
        if not self.items or n_words < self.k:
            return out
        at, row = self._hits(words)
        if not len(at):
            return out
        near: dict = {}                        # item length -> hit positions
        for p, r in zip(at.tolist(), row.tolist()):
            for n in self.lengths[r]:
                near.setdefault(n, []).append(p)
        best: dict = {}
        for n, hits in near.items():
            size = min(n, n_words)
            width = size - self.k + 1
            hits = np.array(hits)
            lo, hi = np.maximum(hits - width + 1, 0), np.minimum(hits, n_words - size)
            step = np.zeros(n_words + 1, dtype=np.int64)
            ok = hi >= lo
            np.add.at(step, lo[ok], 1)
            np.add.at(step, hi[ok] + 1, -1)
            starts = np.flatnonzero(np.cumsum(step)[:-1] > 0)
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > width) + 1):
                for s in range(0, len(run), PIECE):
                    self._verify(words, run[s:s + PIECE], n, size, best)
        for i in sorted(best):
            sim, start, size, d = best[i]
            out.append((self.items[i][0], start, size, d, sim))
        return out

    def _verify(self, words, starts, n, size, best):
        if not len(starts):
            return
        base, width = int(starts[0]), size - self.k + 1
        codes = shingles(word_hashes(words[base:int(starts[-1]) + size]), self.k)
        rel = starts - base
        fps = sliding_fingerprints(codes, rel, width)
        for w, i, d in self.within(fps, n):
            s = int(rel[w])
            sim = similarity(Counter(codes[s:s + width].tolist()), self.items[i][2])
            if sim >= self.threshold and (i not in best or sim > best[i][0]):
                best[i] = (sim, base + s, size, d)


def matcher(spark, rows: list, k: int = SHINGLE, threshold: float = THRESHOLD, radius: int = RADIUS):
    """Column function text -> array of matches with one part's items."""
    from collections.abc import Iterator

    import pyarrow as pa
    shared = spark.sparkContext.broadcast(rows)
    ddl = "array<struct<item_id:bigint,start:bigint,n_words:bigint,distance:int,similarity:double>>"
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()),
                               ("distance", pa.int32()), ("similarity", pa.float64())]))
    names = ("item_id", "start", "n_words", "distance", "similarity")

    def match(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = Items(shared.value, k, threshold, radius)
        for a in texts:
            yield pa.array([[dict(zip(names, m)) for m in items.search(t)] for t in payloads(a)], kind)

    match.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(match, ddl)


def parts(items: DataFrame, key: str = "item_id", text: str = "text"):
    """The benchmark in parts of about ``PART_BYTES``, one at a time."""
    x = items.select(F.col(key).cast("bigint").alias("item_id"), F.col(text).cast("string").cast("binary").alias("text"))
    x = x.where("text is not null").dropDuplicates()
    size = x.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = int(size // PART_BYTES + 1)
    for p in range(n):
        yield [(r.item_id, bytes(r.text)) for r in x.where(F.pmod(F.xxhash64("text"), F.lit(n)) == p).collect()]


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, start, n_words, distance, similarity``: one row per
    document and item it holds a window of."""
    out = None
    for rows in parts(items):
        m = matcher(docs.sparkSession, rows, shingle, threshold)(F.col(text))
        x = docs.select(F.col(key).alias("doc_id"), F.explode_outer(m).alias("m")).where("m is not null").select("doc_id", "m.*")
        out = x if out is None else out.unionByName(x)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", shingle: int = SHINGLE,
                  threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item."""
    for rows in parts(items):
        docs = docs.where(F.size(matcher(docs.sparkSession, rows, shingle, threshold)(F.col(text))) == 0)
    return docs


def op1_benchmark_simhash(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
