"""Toxicity by weak supervision.

1. Lexicon voters are mined: word stems (prefixes) and whole words that mark
   toxic texts in a bounded sample of labelled rows.  Each stem votes "toxic"
   or abstains; pattern voters judge the text's form (capitals, symbols,
   exclamation marks, repeated words) and the absence of stems.
2. A generative label model explains the votes by a hidden label: every voter
   has its own accuracy, and depends on the voter it is most correlated with
   given the label (a tree, so double votes of overlapping stems count once).
   EM estimates accuracies and correlations; the sample's labels take part as
   one more voter, whose accuracy is estimated like that of the others.
3. A linear classifier is fitted to the posterior labels on stem counts and
   form features, and scores every whole text in one pass without a shuffle.

The sample holds at most ``SAMPLE`` labelled ids (smallest hashes) with one
text each (that of the smallest hash), so the label list that is joined
broadcast, the feature list and the matrices fitted on the driver have fixed
bounds whatever the corpus size.

Defined results: null and empty texts are scored by the form features alone;
null labels are skipped; a doc_id labelled more than once is toxic if any
label says so; without labelled rows of both classes every text gets the
share of toxic rows (0 without labels) as its score.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import crc_mod, stash, table

SAMPLE = 20_000             # labelled rows the model is fitted on
MIN_DOCS = 4                # toxic sample texts a stem must occur in
CANDIDATES = 200_000        # stems counted against the clean sample texts
STEMS = 400                 # stems kept as features
VOTERS = 48                 # stems that vote
PREFIX = range(3, 11)       # stem lengths
LABEL_ERROR = 0.02          # rate of wrong labels EM starts from
WORD = re.compile(r"\w+")
CACHE = 500_000


def stems(word: str) -> list:
    """Prefixes of a word, and the word itself marked by ``$``."""
    return [word[:k] for k in PREFIX if k < len(word)] + [word + "$"]


def letter_table() -> np.ndarray:
    """Code point -> letter?"""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), dtype=bool, count=0x110000)


def letter_count(text: str, step: int = 1 << 20, alpha: np.ndarray | None = None) -> int:
    """Letters of the whole text, ``step`` characters at a time."""
    alpha = letter_table() if alpha is None else alpha
    parts = (text[s:s + step].encode("utf-32-le", "surrogatepass") for s in range(0, len(text), step))
    return sum(int(np.count_nonzero(alpha[np.frombuffer(p, dtype="<u4")])) for p in parts)


def form(text: str, words: list, alpha: np.ndarray | None = None) -> list:
    """Form features: capitals, symbols, exclamation, repetition, length."""
    n = len(text) or 1
    letters = letter_count(text, alpha=alpha)
    upper = len(re.findall(r"[A-Z]", text))
    marks = len(re.findall(r"[^\w\s.,]", text))
    distinct = len(set(words))
    return [upper / (letters or 1), marks / n, min(text.count("!"), 20) / 20.0,
            1.0 - distinct / (len(words) or 1), np.log1p(len(words)) / 10.0]


class Matcher:
    """Counts of known stems in a text; holds the letter table of a task."""

    def __init__(self, names: list):
        self.at = {s: i for i, s in enumerate(names)}
        self.memo: dict = {}
        self.alpha = letter_table()

    def counts(self, words: list) -> dict:
        out: Counter = Counter()
        memo, at = self.memo, self.at
        for w, c in Counter(words).items():
            hit = memo.get(w)
            if hit is None:
                if len(memo) >= CACHE:
                    memo.clear()
                hit = memo[w] = tuple(at[s] for s in stems(w) if s in at)
            for i in hit:
                out[i] += c
        return out


def split(text) -> list:
    return WORD.findall((text or "").lower())


def sample_rows(docs: DataFrame, labels: DataFrame, train, key: str = "doc_id", limit: int = SAMPLE) -> DataFrame:
    """``text, y`` of at most ``limit`` labelled ids that meet ``train``, each
    with one text: of several texts of an id that of the smallest hash (rows
    that repeat it come along)."""
    lab = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y"))
    lab = lab.where(train(F.col("_id")) & F.col("_y").isNotNull() & F.col("_id").isNotNull())
    lab = lab.groupBy("_id").agg(F.max("_y").alias("y")).orderBy(F.xxhash64("_id"), "_id").limit(limit)
    text = F.coalesce("text", F.lit(""))
    x = docs.select(F.col(key).alias("_id"), text.alias("text"), F.xxhash64(text).alias("_h")).join(F.broadcast(lab), "_id")
    one = x.groupBy("_id").agg(F.min("_h").alias("_h"))                                  # a row per labelled id
    return x.join(F.broadcast(one), ["_id", "_h"]).select("text", "y")


def one_of_each(rows: DataFrame) -> DataFrame:
    """One row per group of copies: rows that share the smallest hash of
    their word 5-grams (near copies mostly do) and the label."""
    import pyarrow as pa

    def run(batches):
        import xxhash
        for b in batches:
            keys = []
            for t in b.column(0).to_pylist():
                w = split(t)
                grams = zip(*(w[i:] for i in range(5))) if len(w) >= 5 else [w]
                keys.append(min(xxhash.xxh64_intdigest(" ".join(g)) for g in grams) >> 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.int64())], names=["text", "y", "k"])

    x = rows.select("text", "y").mapInArrow(run, "text string, y int, k bigint")
    return x.groupBy("k", "y").agg(F.min("text").alias("text")).select("text", "y")


def _stem_rows(rows: DataFrame, known=None) -> DataFrame:
    """``stem, n``: rows each stem occurs in (only ``known`` ones if given)."""
    import pyarrow as pa

    def run(batches):
        only = None if known is None else set(known.value)
        held: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                found = {s for w in set(split(t)) for s in stems(w)}
                held.update(found if only is None else found & only)
        names = list(held)
        for s in range(0, len(names), 100_000):
            part = names[s:s + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[x] for x in part], pa.int64())],
                                             names=["stem", "n"])

    return rows.select("text").mapInArrow(run, "stem string, n bigint").groupBy("stem").agg(F.sum("n").alias("n"))


def mine(sample: DataFrame, n_pos: int, n_neg: int) -> list:
    """The stems that tell toxic from clean sample rows best (by the
    likelihood ratio), leaving out stems another one stands for."""
    spark = sample.sparkSession
    pos = _stem_rows(sample.where("y = 1")).where(F.col("n") >= min(MIN_DOCS, max(1, n_pos // 4)))
    pos = {r.stem: r.n for r in pos.orderBy(F.desc("n"), "stem").limit(CANDIDATES).collect()}
    neg = {r.stem: r.n for r in _stem_rows(sample.where("y <> 1"), spark.sparkContext.broadcast(list(pos))).collect()}
    scored = []
    for s, a in pos.items():
        b = neg.get(s, 0)
        if a * n_neg <= 3 * b * n_pos:             # not even three times as common
            continue
        g = 0.0
        for seen, all_ in ((a, n_pos), (b, n_neg)):
            p = (a + b) / (n_pos + n_neg)
            for x, e in ((seen, all_ * p), (all_ - seen, all_ * (1 - p))):
                g += x * np.log(x / e) if x else 0.0
        scored.append((-g, len(s), s, a, b))
    scored.sort()
    kept, seen = [], set()
    for _, _, s, a, b in scored:
        w = s.rstrip("$")
        # a longer name of a kept stem that marks the very same rows adds nothing
        if any((w[:k], a, b) in seen for k in range(3, len(w) + 1)):
            continue
        kept.append(s)
        seen.add((w, a, b))
        if len(kept) == STEMS:
            break
    return kept


def vectors(rows: DataFrame, names: list) -> list:
    """Per row its label, form features and stem counts."""
    import pyarrow as pa
    schema = pa.schema([("y", pa.int32()), ("f", pa.list_(pa.float64())), ("i", pa.list_(pa.int32())), ("c", pa.list_(pa.int32()))])

    def run(batches):
        m = Matcher(names)
        for b in batches:
            out = []
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = split(t)
                c = m.counts(w)
                out.append({"y": y, "f": form(t, w, m.alpha), "i": list(c), "c": list(c.values())})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    got = rows.select("text", "y").mapInArrow(run, "y int, f array<double>, i array<int>, c array<int>")
    got = got.limit(SAMPLE + 1).collect()                  # short rows, one per labelled id at most
    if len(got) > SAMPLE:
        raise ValueError(f"more than {SAMPLE} sample rows")
    return got


def features(fm: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Classifier inputs: log counts per stem, their totals, the form."""
    total = counts.sum(axis=1)
    distinct = (counts > 0).sum(axis=1)
    return np.hstack([np.log1p(counts), np.stack([np.log1p(total), np.log1p(distinct), total == 0, total == 1,
                                                  distinct >= 2, np.ones(len(counts))], axis=1), fm])


def ballots(fm: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Votes of all voters: 1 toxic, -1 clean, 0 abstains."""
    hits = counts[:, :VOTERS]
    total = counts.sum(axis=1)
    extra = [np.where(total >= 3, 1, 0), np.where((counts > 0).sum(axis=1) >= 2, 1, 0), np.where(total == 0, -1, 0),
             np.where(total <= 1, -1, 0), np.where(fm[:, 0] > 0.4, 1, 0), np.where(fm[:, 1] > 0.12, 1, 0),
             np.where(fm[:, 2] > 0.1, 1, 0), np.where(fm[:, 3] > 0.7, 1, 0)]
    return np.hstack([(hits > 0).astype(int), np.stack(extra, axis=1)])


def _tables(votes: np.ndarray, parent: np.ndarray, g: np.ndarray) -> np.ndarray:
    """log P(vote | parent's vote, label): [voter, label, parent + 1, vote + 1]."""
    m = votes.shape[1]
    out = np.full((m, 2, 3, 3), 0.5)
    for i in range(m):
        p = votes[:, parent[i]] if parent[i] >= 0 else np.zeros(len(votes), dtype=int)
        np.add.at(out[i, 1], (p + 1, votes[:, i] + 1), g)
        np.add.at(out[i, 0], (p + 1, votes[:, i] + 1), 1 - g)
    return np.log(out / out.sum(axis=3, keepdims=True))


def dependency_tree(votes: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Parent of every voter: the strongest correlations given the label, as
    a maximum spanning forest (-1 for roots)."""
    m = votes.shape[1]
    corr = np.zeros((m, m))
    for w in (g, 1 - g):
        if w.sum() < 2:
            continue
        x = (votes - np.average(votes, axis=0, weights=w)) * np.sqrt(w / w.sum())[:, None]
        cov = x.T @ x
        sd = np.sqrt(np.diag(cov))
        corr = np.maximum(corr, np.abs(cov) / np.maximum(np.outer(sd, sd), 1e-9))
    np.fill_diagonal(corr, 0)
    parent, best, link, open_ = np.full(m, -1), np.zeros(m), np.full(m, -1), np.ones(m, dtype=bool)
    for _ in range(m):
        i = int(np.argmax(np.where(open_, best, -1)))
        parent[i], open_[i] = link[i], False
        better = open_ & (corr[i] > np.maximum(best, 0.1))
        best[better], link[better] = corr[i][better], i
    return parent


def label_model(votes: np.ndarray, y: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Posterior probability of the label toxic, by EM.  The given labels are
    the last voter; its accuracy is estimated like that of the others, from a
    start of ``LABEL_ERROR`` wrong ones."""
    g = np.where(y == 1, 1 - LABEL_ERROR, LABEL_ERROR)
    parent = np.append(dependency_tree(votes, g), -1)        # the labels depend on no voter, and no voter on them
    votes = np.column_stack([votes, np.where(y == 1, 1, -1)])
    for _ in range(rounds):
        t = _tables(votes, parent, g)
        odds = np.full(len(votes), np.log(g.mean() / (1 - g.mean())))
        for i in range(votes.shape[1]):
            p = votes[:, parent[i]] if parent[i] >= 0 else np.zeros(len(votes), dtype=int)
            odds = odds + t[i, 1, p + 1, votes[:, i] + 1] - t[i, 0, p + 1, votes[:, i] + 1]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - g).max() < 1e-4:
            return new
        g = new
    return g


def linear(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 15) -> np.ndarray:
    """Logistic regression on soft targets (Newton steps)."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (target - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train, key: str = "doc_id"):
    """Stem names and classifier weights; (None, share) without two classes."""
    sample = stash(one_of_each(sample_rows(docs, labels, train, key)), "labelled")
    n = {r.y: r.n for r in sample.groupBy(F.when(F.col("y") == 1, 1).otherwise(0).alias("y"))
                                 .agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    if not n_pos or not n_neg:
        return None, (1.0 if n_pos else 0.0)
    names = mine(sample, n_pos, n_neg)
    rows = vectors(sample, names)
    counts = np.zeros((len(rows), max(len(names), VOTERS)), dtype=np.float32)
    for r, v in enumerate(rows):
        counts[r, v.i] = v.c
    fm = np.array([v.f for v in rows])
    y = np.array([v.y == 1 for v in rows]).astype(int)
    post = label_model(ballots(fm, counts), y)
    return names, linear(features(fm, counts), post)


def scorer(spark, model):
    """Column function text -> score in 0..1."""
    from collections.abc import Iterator

    import pyarrow as pa
    shared = spark.sparkContext.broadcast(model)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, w = shared.value
        m = Matcher(names or [])
        for a in texts:
            out = np.zeros(len(a))
            if names is None:
                yield pa.array(out + w)
                continue
            for s in range(0, len(a), 512):
                part = a[s:s + 512].to_pylist()
                counts = np.zeros((len(part), max(len(names), VOTERS)), dtype=np.float32)
                fm = np.zeros((len(part), 5))
                for r, t in enumerate(part):
                    words = split(t)
                    fm[r] = form(t or "", words, m.alpha)
                    for i, c in m.counts(words).items():
                        counts[r, i] = c
                out[s:s + 512] = 1 / (1 + np.exp(-np.clip(features(fm, counts) @ w, -30, 30)))
            yield pa.array(out)

    score.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "double")


def op7_toxicity_weak(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), lambda c: crc_mod(c, 5) != 0)
    x = docs.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), scorer(spark, model)(F.col("text")).alias("score"))
    return x.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
