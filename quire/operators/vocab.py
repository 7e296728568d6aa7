"""Vocabulary building and encoding.

G3 (whitespace dictionary): ids are dense ranks over (frequency desc, token
asc) computed with the distributed prefix sum, never a global sort into one
task.  Encoding numbers the words of a chunk of documents, joins only the chunk's
distinct words with the vocabulary and puts the ids in the places of the numbers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F

from quire.functions.text import ws_tokens
from quire.operators.order import default_buckets, dense_index
from quire.session import ensure_checkpoint_dir, fits, materialize, store

# Vocabularies up to this many rows are broadcast to the encoder; larger ones
# are joined with a shuffle.
BROADCAST_VOCAB_ROWS = 2_000_000
CHUNK = 8 << 20              # characters of the texts whose words are numbered together


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``token, freq``: the only pass over the corpus (partial aggregation)."""
    return (docs.select(F.explode(ws_tokens(text)).alias("token"))
                .groupBy("token").agg(F.count(F.lit(1)).alias("freq")))


def whitespace_vocab(docs: DataFrame, text: str = "text", min_freq: int = 1) -> DataFrame:
    """``token string, id bigint, freq bigint``; id 0 is the most frequent."""
    wc = word_counts(docs, text)
    if min_freq > 1:
        wc = wc.where(F.col("freq") >= min_freq)
    wc = materialize(wc)          # distinct words: read three times below
    v = dense_index(wc.withColumn("_nf", -F.col("freq")), ["_nf", "token"], out="id")
    return store(v.select("token", F.col("id").cast("bigint").alias("id"), "freq"), "vocab")


def add_special_tokens(vocab: DataFrame, specials: DataFrame) -> DataFrame:
    """Append special tokens (``name, content``) after the last id, in
    name order; tokens already present keep their id."""
    size = vocab.agg(F.coalesce(F.max("id") + 1, F.lit(0)).alias("_v")).first()["_v"]
    sp = (specials.join(vocab.select(F.col("token").alias("content")), "content", "left_anti")
                  .withColumn("_r", F.row_number().over(Window.orderBy("name")) - 1)
                  .select(F.col("content").alias("token"), (F.lit(size) + F.col("_r")).cast("bigint").alias("id"),
                          F.lit(0).cast("bigint").alias("freq")))
    return vocab.unionByName(sp)


def vocab_size(vocab: DataFrame) -> DataFrame:
    """``get_piece_size()``."""
    return vocab.agg(F.count(F.lit(1)).alias("vocab_size"))


def special_ids(vocab: DataFrame, specials: DataFrame) -> DataFrame:
    """``bos_id, eos_id, pad_id`` with pad falling back to eos."""
    m = specials.join(vocab.select(F.col("token").alias("content"), "id"), "content")
    piv = m.groupBy().pivot("name", ["bos_token", "eos_token", "pad_token"]).agg(F.first("id"))
    return piv.select(F.col("bos_token").alias("bos_id"), F.col("eos_token").alias("eos_id"),
                      F.coalesce(F.col("pad_token"), F.col("eos_token")).alias("pad_id"))


def vocab_side(vocab: DataFrame, again: bool = False) -> DataFrame:
    """``token, id`` as the distinct words of the chunks are joined with them: a
    broadcast below the checked size, else a shuffle.  A word occurs once per
    chunk, so a very frequent one has as many rows as there are chunks.  With
    ``again`` a large vocabulary is dealt into sorted buckets once, so that of
    many joins none shuffles it."""
    side = vocab.select("token", "id")
    if fits(side, BROADCAST_VOCAB_ROWS):
        return F.broadcast(side)
    if not again:
        return side
    spark, name = vocab.sparkSession, f"quire_vocab_{uuid.uuid4().hex}"
    (side.repartition(default_buckets(side), "token").write.bucketBy(default_buckets(side), "token").sortBy("token")
         .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return spark.table(name)


def _join_vocab(words: DataFrame, vocab: DataFrame) -> DataFrame:
    return words.join(vocab_side(vocab), "token", "left")


def _numbered(rows: DataFrame, text: str, limit: int) -> DataFrame:
    """Every row with its words as numbers inside its chunk (``_nums``), and one row
    per chunk with the chunk's distinct words in that order (``_words``).  A chunk is
    a run of rows of one task with about ``limit`` characters."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext
    cols = [c for c in rows.columns if c != text]
    schema = "_chunk bigint, " + "".join(f"`{c}` {t}, " for c, t in rows.select(*cols).dtypes) + "_nums array<int>, _words array<string>"
    nums, words = pa.list_(pa.int32()), pa.list_(pa.string())

    def run(batches):
        class Numbers(dict):
            def __missing__(self, w):
                n = self[w] = len(self)
                return n

        chunk, known, held, kinds = TaskContext.get().partitionId() << 32, Numbers(), 0, None

        def dictionary():
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), *[pa.nulls(1, k) for k in kinds], pa.nulls(1, nums), pa.array([list(known)], words)],
                names=["_chunk", *cols, "_nums", "_words"])

        for b in batches:
            kinds = [x.type for x in b.columns[:-1]]
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                texts = [t or "" for t in part.columns[-1].to_pylist()]
                got = [np.fromiter(map(known.__getitem__, w), np.int32) for w in map(str.split, texts)]
                ends = np.cumsum([0, *map(len, got)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(texts), pa.int64()), *part.columns[:-1],
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(got))), pa.nulls(len(texts), words)],
                    names=["_chunk", *cols, "_nums", "_words"])
                held += sum(map(len, texts))
                if held >= limit:
                    yield dictionary()
                    chunk, known, held = chunk + 1, Numbers(), 0
        if kinds is not None:
            yield dictionary()

    return rows.select(*cols, text).mapInArrow(run, schema)


def encode(docs: DataFrame, vocab: DataFrame, text: str = "text", key: str = "doc_id",
           out: str = "input_ids", unk_id: int = -1, keep=(), side: DataFrame | None = None) -> DataFrame:
    """Text -> ids (no special tokens, no truncation).

    Words missing from the vocabulary become ``unk_id``.  Documents without
    any token come out with an empty array.  Rows that share ``key`` and ``keep``
    become one, their ids by position.

    Only the distinct words of a chunk of documents meet the vocabulary; their ids
    go back to the chunk, where they take the places of the words' numbers.
    ``side``: what :func:`vocab_side` gave for ``vocab``, for several calls.
    """
    import numpy as np
    import pyarrow as pa
    keep = [c for c in keep if c != key]
    names = [key, *keep]
    x = store(_numbered(docs.select(*names, F.col(text).cast("string").alias("_text")), "_text", CHUNK), "numbered")
    words = x.where(F.col("_words").isNotNull()).select(F.col("_chunk").alias("_of"), F.posexplode("_words").alias("_no", "token"))
    ids = (_join_vocab(words, vocab) if side is None else words.join(side, "token", "left")).select("_of", "_no", F.coalesce(F.col("id").cast("bigint"), F.lit(unk_id)).alias("_id"))
    rows = x.where(F.col("_words").isNull()).select("_chunk", *names, "_nums")

    def run(left, right):
        table = np.zeros(right.num_rows, np.int64)
        table[right.column("_no").to_numpy()] = right.column("_id").to_numpy()
        nums = left.column("_nums").combine_chunks()
        flat = table[nums.flatten().to_numpy(zero_copy_only=False)]
        ends = np.concatenate(([0], np.cumsum(nums.value_lengths().to_numpy(zero_copy_only=False))))
        got = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
        return pa.table([*[left.column(c) for c in names], got], names=[*names, out])

    schema = "".join(f"`{c}` {t}, " for c, t in rows.select(*names).dtypes) + f"`{out}` array<bigint>"
    enc = rows.groupBy("_chunk").cogroup(ids.groupBy("_of")).applyInArrow(run, schema)
    if not rows.groupBy(*names).count().where("count > 1").limit(1).count():
        return enc
    placed = F.transform(out, lambda v, i: F.struct(i.alias("p"), v.alias("v")))
    enc = enc.groupBy(*names).agg(F.array_sort(F.flatten(F.collect_list(placed))).alias("_p"))
    return enc.select(*names, F.transform("_p", lambda s: s["v"]).alias(out))
