"""Language identification with hyperdimensional profiles.

Every letter owns a random +-1 vector (drawn from its code point, so nothing
is stored).  An n-gram vector binds the letters' vectors, each rolled by its
distance from the n-gram's end, by element-wise product; a text's vector is
the bundle (sum) of its n-gram vectors, and a language's prototype the bundle
of all its training texts.  A text gets the language of the highest cosine.

Bundling is linear, so training counts n-grams per language (map-side combine,
then one shuffle of counts) and binds each distinct n-gram once.  Prototypes
are languages x ``DIM`` numbers; their count is checked before they are
broadcast.  Prediction is one pass over the texts without a shuffle.

Text form: lower-cased; every run of non-letters is one boundary symbol, also
before the first and after the last letter.

Defined results: a null text, or one without a letter, is ``und`` with score
0; null or empty training labels are skipped; with nothing learned everything
is ``und``; equal cosines go to the first language in order; the score is the
cosine, cut to 0..1.  Texts are read whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import crc_mod, table

DIM = 1024
N = 3
MAX_LANGS = 10_000
HELD = 1 << 20               # n-gram counts a task holds before passing them on
BITS = 21                    # a code point fits


class Letters:
    """Code point -> letter?, and the letters' vectors."""

    def __init__(self, dim: int = DIM, n: int = N):
        self.dim, self.n = dim, n
        self.alpha = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), dtype=bool, count=0x110000)
        self.codes = np.zeros(0, dtype=np.int64)       # sorted known letters
        self.rows = [np.zeros((0, dim), dtype=np.int8)] * n

    def grams(self, text):
        """Distinct n-gram codes and their counts; empty without a letter."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        ok = self.alpha[cp]
        if not ok.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        x = np.where(ok, cp, 0).astype(np.int64)
        x = np.concatenate(([0], x, [0]))
        x = x[np.concatenate(([True], (x[1:] != 0) | (x[:-1] != 0)))]     # one boundary per run
        m = len(x) - self.n + 1
        if m < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = np.zeros(m, dtype=np.int64)
        for j in range(self.n):
            code = (code << BITS) | x[j:j + m]
        return np.unique(code, return_counts=True)

    def _learn(self, letters):
        new = np.setdiff1d(letters, self.codes)
        if len(new):
            vec = np.stack([(np.random.Generator(np.random.Philox(key=int(c))).integers(0, 2, self.dim, dtype=np.int8) * 2 - 1)
                            for c in new])
            codes = np.concatenate([self.codes, new])
            order = np.argsort(codes)
            base = np.concatenate([self.rows[-1], vec])[order]
            self.codes = codes[order]
            self.rows = [np.roll(base, self.n - 1 - j, axis=1) for j in range(self.n)]

    def vectors(self, codes):
        """Bound n-gram vectors, int8, one row per code."""
        mask = (1 << BITS) - 1
        parts = [(codes >> (BITS * (self.n - 1 - j))) & mask for j in range(self.n)]
        self._learn(np.unique(np.concatenate(parts)))
        out = None
        for j, p in enumerate(parts):
            v = self.rows[j][np.searchsorted(self.codes, p)]
            out = v if out is None else np.multiply(out, v, out=out)
        return out

    def bundle(self, codes, counts, step: int = 4096):
        """Sum of the n-gram vectors, weighted by their counts."""
        out = np.zeros(self.dim)
        for s in range(0, len(codes), step):
            out += counts[s:s + step].astype(np.float32) @ self.vectors(codes[s:s + step]).astype(np.float32)
        return out


def gram_counts(rows: DataFrame, dim: int = DIM, n: int = N) -> DataFrame:
    """``lang, code, n`` summed over all rows of (lang, text)."""
    import pyarrow as pa

    def run(batches):
        letters, held, size = Letters(dim, n), {}, 0

        def out():
            for lang, parts in held.items():
                code = np.concatenate([p[0] for p in parts])
                u, at = np.unique(code, return_inverse=True)
                c = np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u), pa.array(c)],
                                                 names=["lang", "code", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                code, c = letters.grams(text)
                held.setdefault(lang, []).append((code, c))
                size += len(code)
                if size > HELD:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    got = rows.select("lang", "text").mapInArrow(run, "lang string, code bigint, n bigint")
    return got.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def learn(rows: DataFrame, dim: int = DIM, n: int = N):
    """Prototypes of the languages in ``rows`` (lang, text): names in order
    and a matrix of unit rows."""
    import pyarrow as pa

    def run(batches):
        letters, held = Letters(dim, n), {}
        for b in batches:
            lang, code, c = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for x in set(lang):
                at = lang == x
                held[x] = held.get(x, 0) + letters.bundle(code[at], c[at])
        for x, v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([x]), pa.array([v.tolist()], pa.list_(pa.float64()))],
                                             names=["lang", "v"])

    train = rows.where("lang is not null and lang <> '' and text is not null")
    vec = gram_counts(train, dim, n).mapInArrow(run, "lang string, v array<double>")
    cells = vec.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    per = cells.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))      # dim cells a language
    got = per.limit(MAX_LANGS + 1).collect()
    if len(got) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    got = sorted(got, key=lambda r: r.lang)
    mat = np.array([[c.x for c in r.v] for r in got]).reshape(len(got), dim)
    norm = np.linalg.norm(mat, axis=1, keepdims=True)
    return [r.lang for r in got], mat / np.where(norm == 0, 1, norm)


def predictor(spark, model, dim: int = DIM, n: int = N):
    """Column function text -> struct(lang_pred, score, grams); ``grams`` is
    the number of distinct n-grams."""
    from collections.abc import Iterator

    import pyarrow as pa
    shared = spark.sparkContext.broadcast(model)

    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, proto = shared.value
        letters = Letters(dim, n)
        for a in texts:
            lang, score, grams = [], [], []
            for t in a.to_pylist():
                code, c = letters.grams(t)
                grams.append(len(code))
                if not len(code) or not names:
                    lang.append("und"), score.append(0.0)
                    continue
                v = letters.bundle(code, c)
                cos = proto @ (v / (np.linalg.norm(v) or 1.0))
                k = int(np.argmax(cos))
                lang.append(names[k]), score.append(float(min(max(cos[k], 0.0), 1.0)))
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(grams, pa.int32())],
                                             names=["lang_pred", "score", "grams"])

    predict.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(predict, "struct<lang_pred:string,score:double,grams:int>")


def op2_language_hd(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod("doc_id", 4) == 2
    model = learn(docs.where(~held).select("lang", "text"))
    x = docs.select("doc_id", held.alias("held_out"), predictor(spark, model)(F.col("text")).alias("p"))
    return x.select("doc_id", "held_out", "p.lang_pred", "p.score")
