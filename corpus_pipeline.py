"""Corpus pipeline: toxicity, language, near duplicates, benchmark passages,
token ids.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept; ``run`` writes each result as Parquet into the shared folder and reads
it back as the next stage's documents.  All stages but the last return the
columns of ``documents``; the last returns one row per remaining document.

Rows without a text go through every stage as empty texts: the language stage
rejects them, as it does all texts without a letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.llm import bytebpe, decontam, langhd, simhash, toxicity
from quire.llm.base import crc_mod, discard, stash, table

NOISE = 4 / langhd.DIM ** 0.5    # cosine to a prototype an unrelated text stays below: four standard deviations
HALF_GRAMS = 20                  # distinct n-grams at which half of it is asked for
SHINGLE, MAX_BITS = 3, 3         # of the SimHash stage
NONE, KEY, ROW = "__document_none", "__document_key", "__document_row"       # of the near-duplicate stage; no column of documents has these names
KEPT_ROWS = 1_000_000            # removed rows broadcast at most (16 bytes each)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of score 0.5 or more; learns from the labels of the
    documents it is given, as the toxicity query does."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda c: crc_mod(c, 5) != 0)
    return docs.where(toxicity.scorer(spark, model)(F.col("text")) < 0.5)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those that resemble none of the
    learned languages: a cosine within the noise.  Texts of few n-grams have
    small cosines in their own language too, so the bound rises smoothly with
    their number: ``NOISE * grams / (grams + HALF_GRAMS)``."""
    model = langhd.learn(docs.where(crc_mod("doc_id", 4) != 2).select("lang", "text"))
    p = langhd.predictor(spark, model)(F.col("text"))
    bound = F.lit(NOISE) * p["grams"] / (p["grams"] + F.lit(HALF_GRAMS))
    return docs.where((p["lang_pred"] != "und") & (p["score"] > bound))


def _bounded(rows: DataFrame) -> DataFrame:
    """Broadcast behind a size check, else a shuffle join."""
    return F.broadcast(rows) if rows.limit(KEPT_ROWS + 1).count() <= KEPT_ROWS else rows


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of near copies, that of the smallest
    doc_id and, among the rows of that id in the group, of the smallest row
    hash; rows that share a doc_id but are no near copies all stay.  Documents
    without an id come after all others."""
    # a null leaves the hash as it was, so the nulls are hashed beside the values
    row = F.xxhash64(*[docs[c] for c in docs.columns], *[docs[c].isNull() for c in docs.columns])
    found = stash(simhash.near_duplicates(docs.withColumn(ROW, row), key="doc_id", shingle=SHINGLE, max_bits=MAX_BITS, row=ROW), "marked")
    by = {NONE: F.col("doc_id").isNull(), KEY: F.coalesce("doc_id", F.lit(0).cast("bigint"))}
    named, marked, names = docs.withColumns({**by, ROW: row}), found.withColumns(by), [NONE, KEY, ROW]
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col(ROW) == F.col("component_row"))
    gone = stash(marked.where(~first).select(*names).distinct(), "gone")
    twice = stash(marked.where(first).groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*names), "twice")
    kept = named.join(_bounded(gone), names, "left_anti")
    if twice.limit(1).count():
        twice = _bounded(twice)
        again = kept.join(twice, names, "left_semi").dropDuplicates(names)
        kept = kept.join(twice, names, "left_anti").unionByName(again)
    return kept.select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a near copy of a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes the remaining documents."""
    import public_tokenizers as P
    return bytebpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, stored=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("byte_bpe", token_ids),
]

# SQL cannot express the learned stages; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
        if last is not None:
            discard(last)                # the next stage's rows are written
        last = docs
    return docs
