"""Language identification (D5) as relational naive Bayes over character
3-grams of the whole text.

train:  ``groupBy(lang, gram).count()`` over labelled documents (partial
        aggregation: the shuffle carries distinct (lang, gram) per task).
score:  ``sum over gram occurrences of log(c_lang_gram + 1)
        - n_grams * log(N_lang + V) + log prior`` — the add-one smoothed log
        likelihood, rewritten so only grams present in the profile count
        (unseen grams are the ``n_grams`` term).  The size-checked profile is
        broadcast and a row's grams are weighed inside the row; only a profile
        beyond the bound is joined.  Ties go to the smaller language.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from quire.functions.text import WS_CLASS
from quire.session import fits, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # workers need no copy of the package

BROADCAST_PROFILE_ROWS = 5_000_000


# whitespace (Python's set) and Unicode separators fold to one space
GRAM_SPACE = "[" + WS_CLASS[1:-1] + "\\p{Z}]+"


def folded(text_col):
    return F.regexp_replace(F.lower(text_col), GRAM_SPACE, " ")


def char_grams(text_col, n: int = 3):
    """Every overlapping n-gram of the lower-cased text (whitespace runs as
    one space): a capturing look-ahead returns them in one regex pass."""
    return F.regexp_extract_all(folded(text_col), F.lit("(?s)(?=(.{%d}))" % n), 1)


def train_profile(labelled: DataFrame, lang: str = "lang", text: str = "text", n: int = 3):
    """(profile ``lang, gram, w``; per-language constants ``lang, base, prior``)."""
    lg = (labelled.select(lang, F.explode(char_grams(F.col(text), n)).alias("gram"))
                  .groupBy(lang, "gram").agg(F.count(F.lit(1)).alias("c")))
    lg = materialize(lg)                                   # read three times below
    v = lg.select("gram").distinct().count()
    tot = lg.groupBy(lang).agg(F.sum("c").alias("_N"))
    docs = labelled.groupBy(lang).agg(F.count(F.lit(1)).alias("_d"))
    all_docs = F.sum("_d").over(Window.partitionBy())      # one row per language
    consts = (tot.join(docs, lang)
                 .select(lang, (-F.log(F.col("_N") + F.lit(v))).alias("base"),
                         F.log(F.col("_d") / all_docs).alias("prior")))
    prof = lg.select(lang, "gram", F.log(F.col("c") + 1).alias("w"))
    return prof, consts


def detect_language(docs: DataFrame, profile: DataFrame, consts: DataFrame, text: str = "text",
                    key: str = "doc_id", out: str = "lang_pred", n: int = 3, lang: str = "lang") -> DataFrame:
    """``key, out, score``: one row per row of ``docs``, also where rows share
    a key; a null text is judged by the prior alone."""
    cs = sorted(consts.collect(), key=lambda r: r[lang])             # a handful of languages
    # one row per gram with a weight per language
    wide = profile.groupBy("gram").pivot(lang, [c[lang] for c in cs]).agg(F.first("w"))
    wide = wide.select("gram", F.array(*[F.coalesce(F.col(f"`{c[lang]}`"), F.lit(0.0)) for c in cs]).alias("_w"))
    wide = materialize(wide)
    if fits(wide, BROADCAST_PROFILE_ROWS // max(1, len(cs))):
        best = _row_scorer(docs.sparkSession, wide.collect(), cs, n, lang)
        return docs.select(F.col(key), best(folded(F.col(text))).alias("_b")) \
                   .select(key, F.col("_b.lang").alias(out), F.col("_b.score").alias("score"))
    return _joined(docs, wide, cs, text, key, out, n, lang)


def _row_scorer(spark, rows: list, cs: list, n: int, lang: str):
    """Folded text -> struct(lang, score): the grams of a row are counted and
    weighed inside the row, without a shuffle of grams."""
    import numpy as np
    import pyarrow as pa
    at = {r.gram: i for i, r in enumerate(rows)}
    weights = np.array([r["_w"] for r in rows]).reshape(len(rows), len(cs))
    names, base, prior = [c[lang] for c in cs], np.array([c["base"] for c in cs]), np.array([c["prior"] for c in cs])
    shared = spark.sparkContext.broadcast((at, weights, names, base, prior))

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, weights, names, base, prior = shared.value
        for a in texts:
            best, value = [], []
            for t in a.to_pylist():
                t = t or ""
                count = Counter(t[i:i + n] for i in range(len(t) - n + 1))
                known = [(at[g], c) for g, c in count.items() if g in at]
                s = prior + sum(count.values()) * base
                if known:
                    i, c = np.array(known).T
                    s = s + c @ weights[i]
                k = int(np.argmax(s)) if len(names) else -1          # the first language of equals
                best.append(names[k] if names else None), value.append(float(s[k]) if names else None)
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(value, pa.float64())], names=["lang", "score"])

    score.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, "struct<lang:string,score:double>")


def _joined(docs: DataFrame, wide: DataFrame, cs: list, text: str, key: str, out: str, n: int, lang: str) -> DataFrame:
    """The same for a profile beyond the broadcast bound: grams, counted per
    row first, join the profile by a shuffle."""
    docs = materialize(docs.select(key, text).withColumn("_row", F.monotonically_increasing_id()))
    grams = docs.select("_row", F.explode_outer(char_grams(F.col(text), n)).alias("gram")).groupBy("_row", "gram").agg(F.count("gram").alias("_n"))
    hit = grams.join(wide, "gram", "left")
    sums = hit.groupBy("_row").agg(F.sum("_n").alias("_ng"), *[
        F.sum(F.col("_n") * F.coalesce(F.col("_w")[i], F.lit(0.0))).alias(f"_s{i}") for i in range(len(cs))])
    scores = F.array(*[F.struct((F.col(f"_s{i}") + F.col("_ng") * F.lit(c["base"]) + F.lit(c["prior"])).alias("score"),
                                F.lit(-i).alias("rank"), F.lit(c[lang]).alias("lang")) for i, c in enumerate(cs)])
    best = sums.select("_row", F.array_max(scores).alias("_b"))
    return docs.select(key, "_row").join(best, "_row").select(key, F.col("_b.lang").alias(out), F.col("_b.score").alias("score"))
