"""Byte-pair-encoding vocabulary training (G1) and encoding.

Training scans the corpus once (distinct words with counts, SentencePiece
style ``▁`` word prefix) and then works on the word-type table.  One merge at a
time would take a job per merge; a round here takes all merges down to a count:

1. The pairs of the word types are counted.  The most frequent ones, all those
   with at least ``low``, are the pairs of the round.
2. Every word type is cut wherever a pair is less frequent; what is left are runs
   of symbols.  Their distinct forms, summed up over all word types, meet on the
   driver (``FORECAST`` at most, else the round takes fewer pairs).
3. The driver merges in the runs, best pair first (highest count, then smallest
   pair), until no pair has ``low`` any more.
4. The word types are stored anew with these merges.

The runs give the very merges of the whole table.  The inside of a symbol is the
same wherever it stands (merges inside it depend on nothing outside), so the pairs
of two symbols that ever meet over a cut all met there at the start of the round,
as one pair with fewer than ``low`` places; no merge of the round takes it, and a
pair with ``low`` or more places has all of them inside the runs.

Encoding needs no shuffle: a task encodes each distinct word it meets once, by
merging its lowest-ranked pair until none is left, the new words of a batch
together.
"""

from __future__ import annotations

import heapq
import sys
from collections import defaultdict

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from quire.functions.text import ws_tokens
from quire.session import materialize, spread, store

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # workers need no copy of the package

WORD_PREFIX = "▁"
NUL = "\x00"
FORECAST = 400_000           # distinct runs of a round on the driver at most
TOP = 2_000_000              # pairs of a round at most, equal counts included: what is broadcast
STEPS = (64, 4096)           # pairs of a round, at first and at most, but for equal counts
MAX_PIECES = 2_000_000       # characters and merges: what is broadcast
HELD = 200_000               # word types a task works on at a time
CACHE = 500_000              # encoded words a task remembers


# ---- runs on the driver ---------------------------------------------------

class Words:
    """Words (or runs) as lists of symbol ids, with an index from pair to words."""

    def __init__(self, words: list, freqs: list):
        self.words, self.freqs = words, freqs
        self.at = defaultdict(list)
        for i, w in enumerate(words):
            for p in zip(w, w[1:]):
                self.at[p].append(i)

    def counts(self) -> dict:
        out: dict = defaultdict(int)
        for w, f in zip(self.words, self.freqs):
            for p in zip(w, w[1:]):
                out[p] += f
        return out

    def merge(self, a: int, b: int, c: int) -> dict:
        """Replace every ``a b`` by ``c``, left to right; the change of the
        pair counts."""
        change: dict = defaultdict(int)
        for i in set(self.at.pop((a, b), ())):
            w, f = self.words[i], self.freqs[i]
            new, k, n, hit = [], 0, len(w), False
            while k < n:
                if w[k] == a and k + 1 < n and w[k + 1] == b:
                    new.append(c)
                    k += 2
                    hit = True
                else:
                    new.append(w[k])
                    k += 1
            if not hit:                                      # the index keeps words that lost the pair
                continue
            for p in zip(w, w[1:]):
                change[p] -= f
            for p in zip(new, new[1:]):
                change[p] += f
                if c in p:
                    self.at[p].append(i)
            self.words[i] = new
        return {p: d for p, d in change.items() if d}


class Symbols:
    """Symbol strings and their ids; a string has one id."""

    def __init__(self, names: list):
        self.names = list(names)
        self.ids = {n: i for i, n in enumerate(names)}

    def merged(self, a: int, b: int) -> int:
        name = self.names[a] + self.names[b]
        if name not in self.ids:
            self.ids[name] = len(self.names)
            self.names.append(name)
        return self.ids[name]

    def rank(self, pair: tuple, count: int) -> tuple:
        """Order of pairs: highest count, then smallest strings."""
        return -count, self.names[pair[0]], self.names[pair[1]], pair


class Best:
    """Pairs by count, with updates."""

    def __init__(self, symbols: Symbols, counts: dict):
        self.symbols, self.counts = symbols, dict(counts)
        self.heap = [symbols.rank(p, c) for p, c in self.counts.items() if c > 0]
        heapq.heapify(self.heap)

    def update(self, change: dict) -> None:
        for p, d in change.items():
            c = self.counts[p] = self.counts.get(p, 0) + d
            if c > 0:
                heapq.heappush(self.heap, self.symbols.rank(p, c))

    def top(self):
        """(pair, count) of the best pair, or None."""
        while self.heap:
            count, _, _, pair = self.heap[0]
            if self.counts.get(pair) == -count:
                return pair, -count
            heapq.heappop(self.heap)
        return None


# ---- tables ---------------------------------------------------------------

def word_types(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, freq`` — the only pass over the corpus.  NUL characters are
    dropped from words."""
    w = docs.select(F.explode(ws_tokens(F.replace(F.col(text), F.lit(NUL), F.lit("")))).alias("w"))
    w = w.groupBy("w").agg(F.count(F.lit(1)).alias("freq"))
    return w.select(F.concat(F.lit(WORD_PREFIX), F.col("w")).alias("word"), "freq")


def _in_ids(types: DataFrame, ids) -> DataFrame:
    """``freq, syms`` (symbol ids) of the word types."""
    import pyarrow as pa

    def run(batches):
        at = ids.value
        for b in batches:
            syms = [[at[c] for c in w] for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(syms, pa.list_(pa.int32()))], names=["freq", "syms"])

    return types.select("word", "freq").mapInArrow(run, "freq bigint, syms array<int>")


def _held(batches, size: int):
    """The word types of a task, ``size`` at a time (they don't depend on each
    other): frequencies, symbols one word after the other, lengths of the words."""
    import numpy as np

    def flat(some):
        return (np.concatenate([b.column(0).to_numpy() for b in some]), np.concatenate([b.column(1).flatten().to_numpy() for b in some]),
                np.concatenate([np.diff(b.column(1).offsets.to_numpy()) for b in some]).astype(np.int64))

    some: list = []
    for b in batches:
        if b.num_rows:
            some.append(b)
        if sum(x.num_rows for x in some) >= size:
            yield flat(some)
            some = []
    if some:
        yield flat(some)


def _table(pairs: list) -> tuple:
    """Pairs as sorted keys and the place of each in ``pairs``."""
    import numpy as np
    keys = np.array([p[0] << 32 | p[1] for p in pairs], np.int64)
    place = np.argsort(keys)
    return keys[place], place


def _keys(syms):
    """The pair that starts at each position but the last."""
    import numpy as np
    return syms[:-1].astype(np.int64) << 32 | syms[1:]


def _places(syms, sizes, table: tuple):
    """The place in the table of the pair that starts at each position, the
    size of the table if there is none."""
    import numpy as np
    keys, place = table
    out = np.full(len(syms), len(keys))
    if len(keys):
        k = _keys(syms)
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        out[:-1] = np.where(keys[at] == k, place[at], len(keys))
        out[np.cumsum(sizes) - 1] = len(keys)
    return out


def _merged(syms, sizes, table: tuple, made):
    """Merges in every word its first pair of the table (to the symbol in
    ``made``), left to right, until it has none.  Yields the words as they are
    done: their numbers, symbols and lengths."""
    import numpy as np
    word, none = np.arange(len(sizes)), len(made)
    while len(word):
        at = _places(syms, sizes, table)
        least = np.minimum.reduceat(at, np.cumsum(sizes) - sizes)
        todo = least < none
        here = np.repeat(todo, sizes)
        yield word[~todo], syms[~here], sizes[~todo]
        word, sizes, least, syms, at = word[todo], sizes[todo], least[todo], syms[here], at[here]
        if not len(word):
            return
        hit = at == np.repeat(least, sizes)
        # places that overlap (a a a): every second one, from the left
        i = np.arange(len(hit))
        first = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), i, 0))
        hit &= (i - first) % 2 == 0
        syms[hit] = made[at[hit]]
        sizes = sizes - np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
        syms = syms[~np.append(False, hit[:-1])]


def _applied(types: DataFrame, merges: list) -> DataFrame:
    """The word types after the merges (a, b, c); those of one symbol are done with."""
    import numpy as np
    import pyarrow as pa
    todo = types.sparkSession.sparkContext.broadcast((_table(merges), np.array([c for _, _, c in merges], np.int32)))

    def run(batches):
        for freqs, syms, sizes in _held(batches, HELD):
            for word, s, n in _merged(syms, sizes, *todo.value):
                more = n > 1
                word, s, n = word[more], s[np.repeat(more, n)], n[more]
                if len(word):
                    ends = np.append(0, np.cumsum(n)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(freqs[word]), pa.ListArray.from_arrays(ends, pa.array(s))], names=["freq", "syms"])

    return types.mapInArrow(run, "freq bigint, syms array<int>")


def _pair_counts(types: DataFrame) -> DataFrame:
    """``a, b, n``."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for freqs, syms, sizes in _held(batches, HELD):
            inner = np.ones(len(syms), bool)
            inner[np.cumsum(sizes) - 1] = False
            k, f = _keys(syms)[inner[:-1]], np.repeat(freqs, sizes)[inner]
            order = np.argsort(k)
            k, f = k[order], f[order]
            at = np.flatnonzero(np.append(True, k[1:] != k[:-1])[:len(k)])
            if len(at):
                k, f = k[at], np.add.reduceat(f, at)
                yield pa.RecordBatch.from_arrays([pa.array((k >> 32).astype(np.int32)), pa.array((k & 0xFFFFFFFF).astype(np.int32)), pa.array(f)],
                                                 names=["a", "b", "n"])

    return types.mapInArrow(run, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _runs(types: DataFrame, pairs: list) -> DataFrame:
    """``run`` (symbol ids of 32 bits), ``n``: the word types cut where they have
    none of the pairs, pieces of one symbol left out."""
    import numpy as np
    import pyarrow as pa
    known = types.sparkSession.sparkContext.broadcast(_table(pairs))

    def run(batches):
        for freqs, syms, sizes in _held(batches, HELD):
            on = _places(syms, sizes, known.value) < len(known.value[0])     # goes on with the next symbol
            joined = np.append(False, on[:-1])
            starts = (on & ~joined)[on | joined]
            s, f = syms[on | joined], np.repeat(freqs, sizes)[on & ~joined]
            if len(f):
                ends = np.append(np.flatnonzero(starts), len(s)).astype(np.int32) * 4
                r = pa.Array.from_buffers(pa.binary(), len(f), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(s, np.int32))])
                t = pa.table({"run": r, "n": f}).group_by("run").aggregate([("n", "sum")])
                yield from t.select(["run", "n_sum"]).rename_columns(["run", "n"]).to_batches()

    return types.mapInArrow(run, "run binary, n bigint").groupBy("run").agg(F.sum("n").alias("n"))


# ---- training -------------------------------------------------------------

def _best_pair(counts: DataFrame, symbols: Symbols) -> tuple:
    """The first pair in the order of training."""
    place = sorted(range(len(symbols.names)), key=symbols.names.__getitem__)
    ranks = counts.sparkSession.createDataFrame([(i, r) for r, i in enumerate(place)], "id int, r int")        # a row per piece
    x = counts.join(F.broadcast(ranks.select(F.col("id").alias("a"), F.col("r").alias("ra"))), "a")
    x = x.join(F.broadcast(ranks.select(F.col("id").alias("b"), F.col("r").alias("rb"))), "b")
    return tuple(x.orderBy(F.desc("n"), "ra", "rb").select("a", "b").first())


def _round(types: DataFrame, symbols: Symbols, steps: int, most: int) -> tuple[list, int]:
    """The next merges (a, b, c), ``most`` at most, and the number of pairs to
    try in the next round."""
    import numpy as np
    counts = _pair_counts(types)
    while True:
        top = counts.orderBy(F.desc("n")).limit(steps + 1).collect()
        low = top[steps].n + 1 if len(top) > steps else 1    # all pairs with ``low`` are known
        if not top or low <= top[0].n or steps >= TOP:
            break
        steps = min(4 * steps, TOP)                          # all of them have the same count
    while pairs := [(r.a, r.b) for r in top if r.n >= low]:
        runs = _runs(types, pairs).limit(FORECAST + 1).toArrow()
        if runs.num_rows <= FORECAST:
            runs = Words([np.frombuffer(r, np.int32).tolist() for r in runs["run"].to_pylist()], runs["n"].to_pylist())
            order, out = Best(symbols, runs.counts()), []
            while len(out) < most and (got := order.top()) and got[1] >= low:
                (a, b), _ = got
                out.append((a, b, symbols.merged(a, b)))
                order.update(runs.merge(*out[-1]))
            return out, min(2 * len(pairs), STEPS[1]) if len(runs.words) <= FORECAST // 4 else len(pairs)
        low = top[len(pairs) // 2].n + 1                     # too many runs: at most half the pairs
    if not top:
        return [], steps
    a, b = _best_pair(counts, symbols)                       # one merge needs no runs
    return [(a, b, symbols.merged(a, b))], min(steps, STEPS[1])


def train_bpe(docs: DataFrame, num_merges: int | None = None, text: str = "text",
              vocab_size: int | None = None, stats: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """G1: returns (``merges``: rank, left, right; ``vocab``: token, id), for
    a number of merges or a vocabulary size (characters plus merges).

    Vocabulary = single characters (ordered by frequency desc, then text)
    followed by merged symbols in merge order.  ``stats`` receives the number
    of rounds.
    """
    spark = docs.sparkSession
    types = materialize(word_types(docs, text))
    chars = types.select("freq", F.explode(F.split("word", "")).alias("token")).where("token <> ''")
    # Unicode bounds the number of characters
    chars = [r.token for r in chars.groupBy("token").agg(F.sum("freq").alias("f")).orderBy(F.desc("f"), "token").collect()]
    nchar = len(chars)
    if num_merges is None:
        num_merges = max(0, vocab_size - nchar)
    if nchar + num_merges > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    symbols = Symbols(chars)
    types = store(spread(_in_ids(types, spark.sparkContext.broadcast(symbols.ids))))

    merges: list = []
    steps, rounds = STEPS[0], 0
    while len(merges) < num_merges:
        found, steps = _round(types, symbols, steps, num_merges - len(merges))
        if not found:
            break
        rounds += 1
        merges += found
        if len(merges) < num_merges:
            types = store(spread(_applied(types, found)))
    if stats is not None:
        stats.update(rounds=rounds, merges=len(merges))
    rows = [(i, symbols.names[a], symbols.names[b]) for i, (a, b, _) in enumerate(merges)]
    vocab = {c: i for i, c in enumerate(chars)}
    for i, l, r in rows:
        vocab.setdefault(l + r, nchar + i)
    return (spark.createDataFrame(rows, "rank int, left string, right string"),
            spark.createDataFrame(list(vocab.items()), "token string, id int"))


# ---- encoding -------------------------------------------------------------

class Encoder(dict):
    """word -> ids; merges the lowest-ranked pair until none is left."""

    def __init__(self, ranks: dict, ids: dict, unk_id: int):
        import numpy as np
        super().__init__()
        self.ids, self.unk_id = ids, unk_id
        pairs = sorted(ranks, key=lambda p: (ranks[p], p))
        self.at = {n: i for i, n in enumerate(dict.fromkeys(n for l, r in pairs for n in (l, r, l + r)))}
        self.table = _table([(self.at[l], self.at[r]) for l, r in pairs])
        self.made = np.array([self.at[l + r] for l, r in pairs], np.int32)
        self.known = [ids.get(n, unk_id) for n in self.at]   # by symbol

    def learn(self, words) -> None:
        """Encodes the words it has not, all at once."""
        import numpy as np
        if len(self) >= CACHE:
            self.clear()
        new = [w for w in words if w not in self]
        if not new:
            return
        chars, syms = np.unique(np.frombuffer("".join(WORD_PREFIX + w for w in new).encode("utf-32-le"), np.uint32), return_inverse=True)
        for c in map(chr, chars.tolist()):
            if c not in self.at:                             # a character without a merge
                self.at[c] = len(self.known)
                self.known.append(self.ids.get(c, self.unk_id))
        syms = np.array([self.at[chr(c)] for c in chars.tolist()], np.int32)[syms]
        known = np.array(self.known, np.int32)
        for word, s, n in _merged(syms, np.array([len(w) + 1 for w in new]), self.table, self.made):
            s, end = known[s].tolist(), 0
            for w, size in zip(word.tolist(), n.tolist()):
                self[new[w]] = s[end:end + size]
                end += size


def bpe_encode(docs: DataFrame, merges: DataFrame, vocab: DataFrame, text: str = "text",
               key: str = "doc_id", out: str = "input_ids", unk_id: int = -1) -> DataFrame:
    """Document text -> BPE ids (no special tokens, no truncation), one
    row per row of ``docs``; a null text has no ids."""
    import pyarrow as pa
    if vocab.limit(MAX_PIECES + 1).count() > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    model = ({(r.left, r.right): r["rank"] for r in merges.collect()}, {r.token: r.id for r in vocab.select("token", "id").collect()})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[key]

    def run(batches):
        enc = Encoder(*shared.value, unk_id)
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                texts = [(t or "").split() for t in part.column(1).to_pylist()]
                enc.learn({w for t in texts for w in t})
                ids = [[i for w in t for i in enc[w]] for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["k", "ids"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, ids array<int>") \
               .select(F.col("k").alias(key), F.col("ids").alias(out))
