"""Katz backoff language model over words.

Counts are Good-Turing discounted up to ``K`` (larger counts lose ``TAIL``, so
no context is ever left without mass for unseen words); backoff weights make
every context's probabilities sum to one exactly, with one <unknown> event
that takes the unigram mass of all words not seen in training:

    P(w)     = disc(c(w)) / N,              <unknown>: 1 - the sum over words
    P(w | h) = disc(c(h w)) / c(h)          if c(h w) > 0
             = alpha(h) P(w)                if only c(h) > 0
             = P(w)                         else

A text's words follow a start context and are followed by an end word.

Jobs (tables are Parquet in the shared folder, rows are whole lists per chunk
of documents and bucket, see ``chunks``):

A. words of each chunk -> bucket of the word: total counts, word numbers and
   counts of counts; the answers (unigram table) go back to the chunks.
B. pairs of each chunk and document -> bucket of the context: pair counts,
   counts of counts, context table (count, counts of counts, seen unigram
   mass).  Seen pairs are scored up to their discount, unseen ones up to
   alpha; both are known only when all pairs have been counted.
C. bucket by bucket, contexts give alpha to their unseen pairs; sums per
   document go back to the chunks.

Hot contexts (more than a quarter of a bucket's share) are spread over several
buckets by their second word; their sums, at most four per bucket, meet on the
driver.  Everything else that meets there is one row of counts per bucket.

Defined results: null and empty texts are one end token; null ids are scored
like others; repeated rows count and are scored once per row; without
training rows every probability is that of the unknown event, 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import crc_mod, stash, table, word_pieces
from quire.llm.bytebpe import ROWS, _batch
from quire.llm.chunks import (Numbers, bucket_count, by_chunk, chunks, cut, gathered, join, pack, pack_ids, pack_ints, pack_sorted,
                              pack_words, source, unpack, unpack_ids, unpack_ints, unpack_sorted, unpack_words)

K = 5                        # counts up to K are Good-Turing discounted
TAIL = 0.1                   # taken from each larger count
END, START, FIRST = 0, 1, 2  # word numbers: the end word, the start context, the first word
HOT = 4                      # a context of more than 1 / HOT of a bucket's share is spread
TOP = 256                    # most frequent words each bucket reports
BUCKET_BYTES = 16 << 20      # text bytes per bucket, about (some 2.6 million pairs)
FINE = 1 << 40               # partial sums travel as multiples of 1 / FINE


def good_turing(n) -> np.ndarray:
    """Discount ratios d[0..K] from counts of counts n[0..K + 1] (Katz's
    formula; 1 - D/r where the counts are too sparse for it)."""
    n = np.asarray(n, dtype=float)
    flat = min(max(n[1] / (n[1] + 2 * n[2]), 0.05), 0.95) if n[1] else 0.5
    d = np.ones(K + 1)
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        x = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and n[r + 1] and common < 1 else -1.0
        d[r] = x if 0 < x < 1 else 1 - flat / r
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """disc(c) of counts > 0; 0 for 0."""
    c = np.asarray(c)
    return np.where(c > K, c - TAIL, d[np.minimum(c, K)] * c)


class Unigrams:
    """N, V and unigram probabilities by count."""

    def __init__(self, n_tokens: int, n_types: int, n):
        self.n, self.v = int(n_tokens), int(n_types)
        self.d = good_turing(n)
        r = np.arange(1, K + 1)
        n = np.asarray(n, dtype=float)
        left = (n[1:K + 1] * r * (1 - self.d[1:])).sum() + TAIL * (n_types - n[1:K + 1].sum())
        self.unknown = left / n_tokens if n_tokens else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(np.asarray(c) > 0, discounted(c, self.d) / max(self.n, 1), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def ordered(major: np.ndarray, minor: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Order by three non-negative keys; one 64-bit sort when they fit."""
    bits = [int(a.max()).bit_length() if len(a) else 0 for a in (minor, least)]
    top = int(major.max()).bit_length() if len(major) else 0
    if top + sum(bits) <= 63:
        return np.argsort(((major << bits[0] | minor) << bits[1]) | least, kind="stable")
    return np.lexsort((least, minor, major))


def _words(text, raw):
    return word_pieces(raw)


def word_rows(src: DataFrame, buckets: int) -> DataFrame:
    """Job A, map side: distinct words of each chunk and their counts in
    training documents, bucket by bucket."""
    def run(batches):
        for c in chunks(batches, _words):
            groups, _ = c.layout(buckets)
            train = np.repeat(np.array(c.flags, dtype=bool), c.counts)
            n = np.bincount(c.sequence()[train], minlength=len(c.numbers))
            if groups:
                yield _batch([(c.name, b, join([pack_words(w), pack_ints(n[i])])) for b, w, i in groups])
    return src.mapInArrow(run, ROWS)


def sequence_rows(src: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for c in chunks(batches, _words):
            _, place = c.layout(buckets)
            yield _batch([(c.name, -1, join([
                pack_ids(c.ids), pack_ints(c.flags), pack_ints(c.counts),
                pack_ints(place[c.sequence()] if len(place) else []), pack_ints([len(place)])]))])
    return src.mapInArrow(run, ROWS)


def unigram_table(words: DataFrame) -> DataFrame:
    """Job A, bucket side: per chunk the total counts and numbers of its
    words; per bucket (chunk '') types, tokens, counts of counts and its most
    frequent words."""
    def run(batches):
        known, total, held = Numbers(), np.zeros(0, dtype=np.int64), []
        bucket = None
        for b in batches:
            for c, k, blob in zip(*(x.to_pylist() for x in b.columns)):
                w, n = cut(blob)
                w = unpack_words(w)
                at = np.fromiter(map(known.__getitem__, w), dtype=np.int64, count=len(w))
                if len(known) > len(total):
                    total = np.concatenate([total, np.zeros(len(known) - len(total) + len(total) // 2, dtype=np.int64)])
                total[at] += unpack_ints(n)          # words are distinct inside a row
                bucket = k
                held.append((c, pack_ints(at)))
        total = total[:len(known)]
        for c, at in held:
            yield _batch([(c, bucket, join([at, pack_ints(total[unpack_ints(at)])]))])
        if held:
            top = np.argsort(-total, kind="stable")[:TOP]
            counts = np.bincount(np.minimum(total, K + 2), minlength=K + 3)[:K + 2]
            yield _batch([("", bucket, join([pack_ints([(total > 0).sum(), total.sum()]), pack_ints(counts),
                                            pack_ints(top), pack_ints(total[top])]))])
    return words.mapInArrow(run, ROWS)


def _chunk_tokens(parts: dict, name: str, buckets: int, end_count: int):
    """Documents of a chunk and, per token (ends included): document,
    context, word, word count."""
    if -1 not in parts:
        raise RuntimeError(f"chunk {name} was cut differently when it was computed again")
    ids, flags, counts, seq, n = cut(parts.pop(-1))
    ids, flags, counts, seq, n = unpack_ids(ids), unpack_ints(flags), unpack_ints(counts), unpack_ints(seq), int(unpack_ints(n)[0])
    number, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in sorted(parts):
        at, c = cut(parts[k])
        number.append(FIRST + k + buckets * unpack_ints(at)), count.append(unpack_ints(c))
    number, count = np.concatenate(number), np.concatenate(count)
    if len(number) != n:
        raise RuntimeError(f"chunk {name} was cut differently when it was computed again")
    doc = np.repeat(np.arange(len(ids)), counts + 1)
    last = np.cumsum(counts + 1) - 1
    word, cw = np.full(len(doc), END, dtype=np.int64), np.full(len(doc), end_count, dtype=np.int64)
    inner = np.ones(len(doc), dtype=bool)
    inner[last] = False
    word[inner], cw[inner] = number[seq], count[seq]
    ctx = np.concatenate(([START], word[:-1]))
    ctx[np.concatenate(([0], last[:-1] + 1))] = START
    return ids, flags, counts + 1, doc, ctx, word, cw


def pair_rows(rows: DataFrame, model, buckets: int) -> DataFrame:
    """Job B, chunk side: per bucket the chunk's distinct (context, word,
    document) with their counts; one row (negative bucket) of facts about the
    chunk's documents."""
    def run(batches):
        uni, end_count, hot = Unigrams(*model.value[0]), *model.value[1:]
        hot_ids = np.array(sorted(hot), dtype=np.int64)
        spread = np.array([hot[i][1] for i in sorted(hot)], dtype=np.int64)
        import zlib
        for name, parts in by_chunk(batches):
            ids, flags, n, doc, ctx, word, cw = _chunk_tokens(parts, name, buckets, end_count)
            base = np.bincount(doc, weights=uni.base(cw), minlength=len(ids))
            seen = np.bincount(doc, weights=cw > 0, minlength=len(ids)).astype(np.int64)
            facts = join([pack_ids(ids), pack_ints(flags), pack_ints(n), pack_ints(seen), pack(base.tobytes())])
            out = [(name, -1 - zlib.crc32(name.encode()) % buckets, facts)]
            key = doc * 2 + flags[doc]
            o = ordered(ctx, word, key)
            ctx, word, key, cw = ctx[o], word[o], key[o], cw[o]
            new = np.concatenate(([True], (ctx[1:] != ctx[:-1]) | (word[1:] != word[:-1]) | (key[1:] != key[:-1])))
            at = np.flatnonzero(new)
            count = np.diff(at, append=len(ctx))
            ctx, word, key, cw = ctx[at], word[at], key[at], cw[at]
            salt = np.zeros(len(ctx), dtype=np.uint64)
            if len(hot_ids):
                h = np.minimum(np.searchsorted(hot_ids, ctx), len(hot_ids) - 1)
                is_hot = hot_ids[h] == ctx
                salt[is_hot] = mix(word[is_hot] + 1) % spread[h[is_hot]].astype(np.uint64)
            b = (mix(mix(ctx) + salt) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(b, kind="stable")
            edges = np.concatenate((np.flatnonzero(np.diff(b[by], prepend=-1)), [len(by)]))
            for s, e in zip(edges[:-1], edges[1:]):
                i = by[s:e]
                out.append((name, int(b[i[0]]), join([pack_sorted(ctx[i]), pack_ints(word[i]), pack_ints(key[i]),
                                                      pack_ints(count[i]), pack_ints(cw[i])])))
                if len(out) >= 64:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)
    return rows.mapInArrow(run, ROWS)


def _runs(*keys) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.zeros(len(keys[0]), dtype=bool)
    if len(new):
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def score_pairs(rows: DataFrame, model) -> DataFrame:
    """Job B, bucket side.  Rows passed on: facts about documents (as they
    are); 'hot' partial sums of spread contexts; '' contexts and counts of
    pair counts; per chunk the sums of its documents, how often each
    discounted count was used, and the pairs that wait for alpha."""
    def run(batches):
        uni, _, hot = Unigrams(*model.value[0]), *model.value[1:]
        held, names, bucket = [[] for _ in range(6)], [], None
        for b in batches:
            for c, k, blob in zip(*(x.to_pylist() for x in b.columns)):
                if k < 0:
                    yield _batch([(c, k, blob)])
                    continue
                ctx, word, key, count, cw = cut(blob)
                ctx = unpack_sorted(ctx)
                # documents of a chunk, their counts and chunks of a bucket fit 32 bits
                for col, x in zip(held, (ctx, unpack_ints(word), unpack_ints(key).astype(np.int32), unpack_ints(count).astype(np.int32),
                                         unpack_ints(cw), np.full(len(ctx), len(names), dtype=np.int32))):
                    col.append(x)
                names.append(c)
                bucket = k
        if not names:
            return
        for j in range(6):                           # column by column: the parts go as the whole is made
            held[j] = np.concatenate(held[j])
        o = ordered(held[0], held[1], held[5])
        for j in range(6):
            held[j] = held[j][o]
        del o
        ctx, word, key, count, cw, chunk = held
        del held
        pair = _runs(ctx, word)
        r = np.add.reduceat(count * (key & 1), pair, dtype=np.int64)
        group = _runs(ctx[pair])
        ids = ctx[pair][group]
        cold = np.add.reduceat(r, group)
        known = np.array([hot.get(int(i), (-1, 0))[0] for i in ids], dtype=np.int64) if hot else np.full(len(ids), -1)
        c1 = np.where(known >= 0, known, cold)
        times = np.stack([np.add.reduceat((r == j).astype(np.int64), group) for j in range(1, K + 1)])
        tail = np.add.reduceat((r > K).astype(np.int64), group)
        mass = np.add.reduceat(np.where(r > 0, uni.p(cw[pair]), 0.0), group)
        stats = pack_ints(np.bincount(np.minimum(r, K + 2), minlength=K + 3)[:K + 2])
        spread = np.flatnonzero(known >= 0)
        if len(spread):
            yield _batch([("hot", bucket, join([pack_ints(ids[spread]), pack_ints(times[:, spread].ravel()), pack_ints(tail[spread]),
                                               pack(mass[spread].tobytes())]))])
        yield _batch([("counts", bucket, stats)])
        yield _batch([("", bucket, join([stats, pack_sorted(ids), pack_ints(c1), pack_ints(times.ravel()), pack_ints(tail),
                                        pack(mass.tobytes())]))])
        where = np.repeat(np.arange(len(group), dtype=np.int32), np.diff(group, append=len(pair)))     # context of each pair
        of = np.repeat(np.arange(len(pair), dtype=np.int32), np.diff(pair, append=len(ctx)))
        del ctx, word, pair, group, times, tail, mass, cold, known
        by = np.argsort(chunk, kind="stable")
        edges = np.concatenate((np.flatnonzero(np.diff(chunk[by], prepend=-1)), [len(by)]))
        for s, e in zip(edges[:-1], edges[1:]):
            i = by[s:e]
            p = of[i]
            re, ce, n, doc = r[p], c1[where[p]], count[i], key[i] >> 1
            with np.errstate(divide="ignore", invalid="ignore"):
                seen = np.log10(np.where(re > K, re - TAIL, re)) - np.log10(ce)
            value = np.where(re > 0, seen, np.log10(uni.p(cw[i]))) * n
            docs, at = np.unique(doc, return_inverse=True)
            used = np.stack([np.bincount(at, weights=n * (re == j), minlength=len(docs)) for j in range(1, K + 1)])
            w = (re == 0) & (ce > 0)
            yield _batch([(names[int(chunk[i[0]])], bucket, join([
                pack_ints(docs), pack_sums(np.bincount(at, weights=value, minlength=len(docs))), pack_ints(used.astype(np.int64).ravel()),
                pack_ints(doc[w]), pack_ints(where[p[w]]), pack_ints(n[w])]))])
    return rows.mapInArrow(run, ROWS)


def pack_sums(x: np.ndarray) -> bytes:
    """Sums of log probabilities (never positive), rounded to 1 / FINE; as
    they are where that doesn't fit 62 bits."""
    if len(x) and x.min() * FINE < -float(1 << 62):
        return b"f" + pack(x.tobytes())
    return b"i" + pack_ints(np.maximum(np.rint(x * -FINE), 0).astype(np.int64))


def unpack_sums(data: bytes) -> np.ndarray:
    if data[:1] == b"f":
        return np.frombuffer(unpack(data[1:])).copy()
    return unpack_ints(data[1:]) / -float(FINE)


def alpha(c1, times, tail, mass, d: np.ndarray) -> np.ndarray:
    """Backoff weights of contexts from their counts of counts."""
    left = ((times * (np.arange(1, K + 1) * (1 - d[1:]))[:, None]).sum(axis=0) + TAIL * tail) / np.maximum(c1, 1)
    return left / np.maximum(1.0 - mass, 1e-12)


def settle(rows: DataFrame, model) -> DataFrame:
    """Job C, bucket side: per chunk the finished sums of its documents."""
    def run(batches):
        d, hot = model.value
        weight = None
        for b in batches:
            for c, k, blob in zip(*(x.to_pylist() for x in b.columns)):
                if k < 0:
                    yield _batch([(c, k, blob)])
                elif c == "":
                    _, ids, c1, times, tail, mass = cut(blob)
                    ids = unpack_sorted(ids)
                    weight = alpha(unpack_ints(c1), unpack_ints(times).reshape(K, -1), unpack_ints(tail), np.frombuffer(unpack(mass)), d)
                    if hot:
                        for i in np.flatnonzero(np.isin(ids, list(hot))):
                            weight[i] = hot[int(ids[i])]
                    with np.errstate(divide="ignore"):
                        weight = np.log10(weight)
                elif c not in ("hot", "counts"):
                    docs, value, used, doc, ctx, count = cut(blob)
                    docs, value = unpack_ints(docs), unpack_sums(value)
                    value += (unpack_ints(used).reshape(K, -1) * np.log10(d[1:])[:, None]).sum(axis=0)
                    doc = unpack_ints(doc)
                    if len(doc):
                        np.add.at(value, np.searchsorted(docs, doc), weight[unpack_ints(ctx)] * unpack_ints(count))
                    yield _batch([(c, k, join([pack_ints(docs), pack_sums(value)]))])
    return rows.mapInArrow(run, ROWS)


def document_scores(rows: DataFrame, n_tokens: int) -> DataFrame:
    """Job C, chunk side: one row per document."""
    import pyarrow as pa

    def run(batches):
        for name, parts in by_chunk(batches):
            ids, flags, n, seen, base = cut(parts.pop(min(parts)))
            ids, base = unpack_ids(ids), np.frombuffer(unpack(base))
            score = np.zeros(len(ids))
            for k in sorted(parts):
                docs, value = cut(parts[k])
                score[unpack_ints(docs)] += unpack_sums(value)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(unpack_ints(flags) == 0), pa.array(unpack_ints(n)), pa.array(unpack_ints(seen)),
                pa.array(np.full(len(ids), n_tokens)), pa.array(base), pa.array(score)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                "base_score double, score double")


def score(docs: DataFrame, train, key: str = "doc_id", text: str = "text", stored: bool = False) -> DataFrame:
    """Scores of all rows by the model learned from rows that meet ``train``.
    ``stored``: rows are read straight from files (see ``bytebpe``)."""
    spark = docs.sparkSession
    if not stored:
        docs = stash(docs.select(key, text, train.alias("_train")), "texts")
        train = F.col("_train")
    src = source(docs, key, text, train)
    buckets = bucket_count(src, "text", BUCKET_BYTES)
    parts = word_rows(src, buckets).repartitionById(buckets, F.col("bucket"))
    uni = stash(unigram_table(parts), "unigrams")

    ends = docs.where(train).count()
    n_types, n_tokens, n, top = int(ends > 0), ends, np.zeros(K + 2, dtype=np.int64), {START: ends, END: ends}
    n[min(ends, K + 1)] += ends <= K + 1
    for r in uni.where("chunk = ''").toLocalIterator():                  # one row of counts per bucket
        size, counts, ids, c = (unpack_ints(x) for x in cut(bytes(r.blob)))
        n_types, n_tokens, n = n_types + int(size[0]), n_tokens + int(size[1]), n + counts
        for i, x in zip(ids.tolist(), c.tolist()):
            if x * HOT * buckets > size[1]:
                top[FIRST + r.bucket + buckets * i] = x
    # context -> its count and the number of buckets it is spread over
    hot = {i: (c, -(-c * HOT * buckets // n_tokens)) for i, c in top.items() if i != END and c * HOT * buckets > n_tokens}
    lm = spark.sparkContext.broadcast(((n_tokens, n_types, n), ends, hot))      # plain values: a class would be looked up by name

    rows = gathered(uni.where("chunk <> ''").unionByName(sequence_rows(src, buckets)), buckets)
    pairs = pair_rows(rows, lm, buckets).repartitionById(buckets, F.expr(f"pmod(bucket, {buckets})"))
    grams = stash(score_pairs(pairs, lm), "contexts")

    n2, sums = counts_of_counts(grams), {}
    for r in grams.where("chunk = 'hot'").toLocalIterator():             # at most 2 HOT contexts per bucket
        ids, times, tail, mass = cut(bytes(r.blob))
        ids, times, tail, mass = unpack_ints(ids), unpack_ints(times).reshape(K, -1), unpack_ints(tail), np.frombuffer(unpack(mass))
        for j, i in enumerate(ids.tolist()):
            t = sums.setdefault(i, [np.zeros(K), 0, 0.0])
            sums[i] = [t[0] + times[:, j], t[1] + tail[j], t[2] + mass[j]]
    d = good_turing(n2)
    weights = {i: float(alpha(np.array([hot[i][0]]), t[:, None], np.array([m]), np.array([u]), d)[0]) for i, (t, m, u) in sums.items()}
    final = spark.sparkContext.broadcast((d, weights))
    done = settle(grams.repartitionById(buckets, F.expr(f"pmod(bucket, {buckets})")).sortWithinPartitions("chunk"), final)
    return document_scores(gathered(done, buckets), n_tokens)


def counts_of_counts(grams: DataFrame) -> np.ndarray:
    """Sums over the buckets: K + 2 numbers."""
    import pyarrow as pa

    def run(batches):
        n = np.zeros(K + 2, dtype=np.int64)
        for b in batches:
            for blob in b.column(0).to_pylist():
                n += unpack_ints(blob)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(K + 2)), pa.array(n)], names=["i", "n"])

    got = grams.where("chunk = 'counts'").select("blob").mapInArrow(run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n"))
    out = np.zeros(K + 2, dtype=np.int64)
    for r in got.collect():
        out[r.i] = r.n
    return out


def op4_katz_lm(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) != 2, stored=True)
