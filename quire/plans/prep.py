"""User-level compositions of the operators (L1-L4).

``prepare_corpus`` is the whole default flow: extract -> collapse ->
(optional filters) -> exact dedupe -> (optional near-dup) -> scrub ->
tokenize -> train/test split -> pack.  Each step is a ``DataFrame ->
DataFrame`` operator, so the plan stays one lazy Catalyst graph except where
an iterative step (near-dup clusters) or a multi-pass step (prefix sums)
materialises its input once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from quire.functions.html import extract_text
from quire.functions.pii import scrub
from quire.operators.dedupe import exact_dedupe
from quire.operators.filters import (collapse_documents, filter_keywords, filter_language,
                                     filter_min_len, SECURITY_KEYWORDS)
from quire.operators.order import train_test_split
from quire.operators.pack import pack_sequences
from quire.operators.vocab import encode, whitespace_vocab
from quire.session import materialize, store


@dataclass
class PrepConfig:
    keywords: list | None = None          # D3, off by default
    min_len: int = 0                      # D2
    lang: str | None = None               # D4, off (the default run skips it)
    near_dup_threshold: float | None = None   # F2/F4, off by default
    near_dup_method: str = "lsh"          # "lsh" stays linear in cluster size; "exact" = F3 pairs
    scrub_rules: str = "reference"        # C9
    seq_len: int = 64                     # H1
    train_frac: float = 0.9               # E5
    shard: str | None = None              # E3: column that confines dedupe, split and packing to a shard
    materialize: bool = True              # cut lineage before the prefix sums


DEFAULT = PrepConfig()
# The strict configuration: keywords, min length 100, near-dup 0.8, 4096 windows.
STRICT = PrepConfig(keywords=SECURITY_KEYWORDS, min_len=100, near_dup_threshold=0.8, seq_len=4096)


def pages_to_documents(pages: DataFrame, keep=()) -> DataFrame:
    """``page_id, url, html`` -> ``doc_id, text`` (empty extractions kept)."""
    return pages.select(F.col("page_id").alias("doc_id"), F.coalesce(extract_text("html"), F.lit("")).alias("text"), *keep)


def _shard(cfg: PrepConfig) -> list:
    return [cfg.shard] if cfg.shard else []


def clean_documents(docs: DataFrame, cfg: PrepConfig = DEFAULT) -> dict[str, DataFrame]:
    """Stages up to scrubbed line documents; returns every stage by name."""
    stages = {"raw": docs}
    x = collapse_documents(docs)
    if cfg.lang:
        x = filter_language(x, cfg.lang)
    if cfg.keywords:
        x = filter_keywords(x, cfg.keywords)
    x = filter_min_len(x, cfg.min_len)
    if cfg.materialize and (cfg.keywords or cfg.near_dup_threshold):
        x = store(x, "filtered")              # the filters run once, not once per pass of the dedupe steps
    stages["filtered"] = x
    x = exact_dedupe(x.select("doc_id", "text", *_shard(cfg)), group=_shard(cfg))
    if cfg.near_dup_threshold:
        if cfg.shard:
            raise ValueError("near duplicates are searched over the whole corpus, not per shard")
        from quire.operators.dedupe import near_dup_survivors
        x = near_dup_survivors(x, threshold=cfg.near_dup_threshold, method=cfg.near_dup_method)
    stages["deduped"] = x
    x = x.withColumn("text", scrub("text", cfg.scrub_rules))
    stages["scrubbed"] = x
    return stages


def tokenize_and_pack(docs: DataFrame, cfg: PrepConfig = DEFAULT, vocab: DataFrame | None = None):
    """G3/G2 + E5 + H1: returns (vocab, packed) with packed =
    ``[shard,] split, seq_id, input_ids``."""
    if cfg.materialize:
        docs = store(docs, "docs")
    vocab = vocab if vocab is not None else whitespace_vocab(docs)
    group = _shard(cfg)
    split = train_test_split(docs.select("doc_id", "text", *group), ["doc_id"], cfg.train_frac, group=group)
    enc = encode(split, vocab, keep=["split", *group])
    if cfg.materialize:
        enc = store(enc, "encoded")
    packed = pack_sequences(enc, cfg.seq_len, group=[*group, "split"])
    return vocab, packed


def prepare_corpus(pages: DataFrame, cfg: PrepConfig = DEFAULT) -> dict[str, DataFrame]:
    """L1/L2: pages -> every stage, ending with ``packed``."""
    docs = pages_to_documents(pages, _shard(cfg))
    if cfg.materialize:
        docs = materialize(docs)              # the extraction runs once, not once per stage
    stages = clean_documents(docs, cfg)
    stages["extracted"] = docs
    vocab, packed = tokenize_and_pack(stages["scrubbed"], cfg)
    stages["vocab"] = vocab
    stages["packed"] = packed
    return stages
