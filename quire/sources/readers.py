"""Readers for the text formats of the source scripts.

Order is meaning for these files, so every reader materialises ``ord``: a
dense 0-based position in (sorted file path, position in file) order.  It is
computed without a global sort: rows are tagged with their file split and
their row number inside the split; only the per-split counts (one row per
file split, bounded by the file listing) are prefix-summed and joined back.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quire.functions.text import py_strip, text_to_ids
from quire.operators.order import running_offset
from quire.session import fits, materialize

BROADCAST_SPLITS = 1_000_000
ROW_BITS = (1 << 33) - 1       # monotonically_increasing_id keeps the row number in the low 33 bits


def _with_ord(raw: DataFrame) -> DataFrame:
    """``raw`` must carry ``_f`` (file path), ``_bs`` (split start) and
    ``_m`` (monotonically_increasing_id taken right after the scan)."""
    x = raw.withColumn("_r", F.col("_m").bitwiseAND(F.lit(ROW_BITS)))
    blocks = x.groupBy("_f", "_bs").agg(F.count(F.lit(1)).alias("_c"), F.min("_r").alias("_r0"))
    blocks = materialize(running_offset(materialize(blocks), ["_f", "_bs"], "_c", out="_base"))      # one pass over the lines
    side = F.broadcast(blocks) if fits(blocks, BROADCAST_SPLITS) else blocks
    return (x.join(side, ["_f", "_bs"])
             .withColumn("ord", F.col("_base") + F.col("_r") - F.col("_r0"))
             .drop("_r", "_c", "_r0", "_base", "_m", "_bs"))


def read_text_ordered(spark: SparkSession, path, line_sep: str | None = None,
                      keep_path: bool = False) -> DataFrame:
    """``ord bigint, value string`` (+ ``file_path``): one row per record."""
    r = spark.read
    if line_sep is not None:
        r = r.option("lineSep", line_sep)
    raw = r.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_bs"),
        F.monotonically_increasing_id().alias("_m"))
    out = _with_ord(raw)
    if keep_path:
        return out.withColumnRenamed("_f", "file_path")
    return out.drop("_f")


def read_line_list(spark: SparkSession, path, col: str = "url") -> DataFrame:
    """A1: one entry per line, stripped, blank lines dropped (seeds, allow-list)."""
    df = read_text_ordered(spark, path)
    return df.select("ord", py_strip("value").alias(col)).where(F.col(col) != "")


def read_keywords(spark: SparkSession, path) -> DataFrame:
    """A10: keyword file, one per line or comma separated; stripped, distinct."""
    df = read_text_ordered(spark, path)
    kw = df.select(F.explode(F.split("value", ",")).alias("keyword")).select(py_strip("keyword").alias("keyword"))
    return kw.where(F.col("keyword") != "").distinct()


def read_page_dump(spark: SparkSession, path, framing: str = "sentinel",
                   marker: str = "---ENDDOC---") -> DataFrame:
    """A2: raw page dump -> ``ord bigint, url string, html string``.

    ``framing="sentinel"``: one record per ``marker`` line; the ``URL:`` line
    heads the record and is kept as ``url``; the ``<html>`` wrapper added by
    the writer is removed.  ``framing="url"`` reproduces the source reader:
    a line starting with ``URL:`` closes the current record and is dropped,
    everything else (wrapper and marker lines too) is the page; a dump without
    ``URL:`` lines is one page.
    """
    if framing == "sentinel":
        recs = read_text_ordered(spark, path, line_sep=marker + "\n")
        # the last record may lack the line break after its marker
        v = F.regexp_replace(F.regexp_replace("value", "^\\n", ""), re.escape(marker) + "\\z", "")
        url = F.regexp_extract(v, "^URL: ([^\\n]*)", 1)
        body = F.regexp_replace(v, "^URL: [^\\n]*\\n", "")
        body = F.regexp_replace(body, "(?s)^<html>\\n(.*)\\n</html>\\n?$", "$1")
        out = recs.select("ord", F.when(url != "", url).alias("url"), body.alias("html"))
        return out.where(F.col("html") != "")
    if framing != "url":
        raise ValueError(framing)
    lines = read_text_ordered(spark, path, line_sep="\n")
    hdr = F.col("value").startswith("URL:")
    x = running_offset(lines.withColumn("_h", hdr.cast("bigint")), ["ord"], "_h", out="rec", inclusive=True)
    body = x.where(~F.col("_h").cast("boolean"))
    pages = (body.groupBy("rec")
                 .agg(F.array_sort(F.collect_list(F.struct("ord", "value"))).alias("_l"))
                 .select(F.col("rec").alias("ord"),
                         F.lit(None).cast("string").alias("url"),
                         F.concat_ws("", F.transform("_l", lambda s: F.concat(s["value"], F.lit("\n"))))
                          .alias("html")))
    return pages


def read_sentinel_docs(spark: SparkSession, path, marker: str = "---ENDDOC---",
                       drop_invalid_utf8: bool = True) -> DataFrame:
    """A3: documents separated by ``marker``; stripped, blanks dropped.
    ``marker="ENDDOC"`` reproduces the source (and its ``---`` residue)."""
    recs = read_text_ordered(spark, path, line_sep=marker)
    v = F.col("value")
    if drop_invalid_utf8:
        # bad bytes become U+FFFD and go; a U+FFFD of the text itself is put
        # aside as a noncharacter meanwhile
        kept = F.make_valid_utf8(F.replace(v, F.lit("\ufffd"), F.lit("\U0010fffe")))
        kept = F.replace(F.replace(kept, F.lit("\ufffd"), F.lit("")), F.lit("\U0010fffe"), F.lit("\ufffd"))
        v = F.when(F.is_valid_utf8(v), v).otherwise(kept)
    out = recs.select(F.col("ord").alias("doc_id"), py_strip(v).alias("text"))
    return out.where(F.col("text") != "")


def read_line_docs(spark: SparkSession, path, drop_blank: bool = True) -> DataFrame:
    """A4: one document per line.  ``drop_blank`` strips and drops blanks
    (dedupe, pack); ``False`` keeps every line as is (scrub)."""
    df = read_text_ordered(spark, path).select(F.col("ord").alias("doc_id"), F.col("value").alias("text"))
    if drop_blank:
        df = df.withColumn("text", py_strip("text")).where(F.col("text") != "")
    return df


def manifest_files(spark: SparkSession, path: str, prefix: str, shard=None) -> list[str]:
    """The files that ``sinks.write_shard_files`` committed, in order; those of
    one shard with ``shard``."""
    m = spark.read.schema("ord long, shard string, number int, file string").json(f"{path.rstrip('/')}/{prefix}.manifest")
    if shard is not None:
        m = m.where(F.col("shard") == F.lit(str(shard)))
    return [f"{path.rstrip('/')}/{r['file']}" for r in m.orderBy("ord").collect()]


def read_sequence_shards(spark: SparkSession, path: str, prefix: str, shard=None, tolerant: bool = False) -> DataFrame:
    """A7 over numbered files: the sequences of the shards that the manifest
    under ``path`` names, in its order (file names sort as the manifest does).  A
    file that it names and that is not there is an error."""
    files = manifest_files(spark, path, prefix, shard)
    if not files:
        extra = ", line string, ok boolean" if tolerant else ""
        return spark.createDataFrame([], "seq_id bigint, input_ids array<int>" + extra)
    return read_sequences(spark, files, tolerant)


def read_sequences(spark: SparkSession, path, tolerant: bool = False) -> DataFrame:
    """``.seq`` files (glob, sorted by path) -> ``seq_id, input_ids``.

    Blank lines are skipped.  ``tolerant`` keeps going past malformed lines
    (non-integer token) and marks them ``ok = false``; the strict reader
    fails on them like ``int()`` does.
    """
    df = read_text_ordered(spark, path, keep_path=True)
    df = df.where(py_strip("value") != "")
    if not tolerant:
        return df.select(F.col("ord").alias("seq_id"), text_to_ids("value", strict=True).alias("input_ids"))
    ids = text_to_ids("value", strict=False)
    return df.select(F.col("ord").alias("seq_id"), ids.alias("input_ids"), F.col("value").alias("line"),
                     F.forall(ids, lambda x: x.isNotNull()).alias("ok"))


SFT_SCHEMA = "input string, trace string, answer string"


def read_sft_records(spark: SparkSession, path, pretty: bool = True) -> DataFrame:
    """``{input, trace, answer}`` records.  The sample spans several lines
    per record, so records are split at ``}`` + newline; plain JSON lines go
    through the JSON source."""
    if not pretty:
        return spark.read.schema(SFT_SCHEMA).json(path)
    recs = read_text_ordered(spark, path, line_sep="}\n")
    rec = F.concat(py_strip("value"), F.lit("}"))
    rec = F.regexp_replace(rec, "\\}\\}$", "}")
    parsed = recs.where(py_strip("value") != "").select("ord", F.from_json(rec, SFT_SCHEMA).alias("r"))
    return parsed.select("ord", "r.*")


SPECIAL_SCHEMA = T.MapType(T.StringType(), T.StructType([
    T.StructField("content", T.StringType()), T.StructField("lstrip", T.BooleanType()),
    T.StructField("normalized", T.BooleanType()), T.StructField("rstrip", T.BooleanType()),
    T.StructField("single_word", T.BooleanType())]))


def read_special_tokens(spark: SparkSession, path) -> DataFrame:
    """Special-token map -> ``name, content, lstrip, normalized, rstrip, single_word``."""
    raw = spark.read.option("wholetext", True).text(path)
    m = raw.select(F.from_json("value", SPECIAL_SCHEMA).alias("m"))
    return m.select(F.explode("m").alias("name", "t")).select("name", "t.*")
