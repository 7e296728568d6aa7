"""Shared helpers: tables, scratch tables in the shared folder, byte words."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.session import ensure_checkpoint_dir

WS = re.compile(rb"[ \t-\r]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never a local one)."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    lineage, survives lost executors, and is computed once.  The shuffle files
    of the write are dropped as soon as it has ended."""
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the folder of a :func:`stash` result that nothing reads any more."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    jvm = spark.sparkContext._jvm
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in path and path.startswith(root):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def crc_mod(col, m: int):
    """crc32 of an id's decimal text, modulo ``m`` (null ids count as '')."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(m)


def word_pieces(text: bytes, limit: int = 1 << 22):
    """Lower-cased (A-Z) words of ``text`` in lists covering at most about
    ``limit`` bytes each; cuts fall on white space, so no word is split.
    ``bytes.split`` cuts on exactly 0x20 and 0x09-0x0D."""
    n = len(text)
    if n <= limit:
        yield text.lower().split()
        return
    at = 0
    while at < n:
        end = at + limit
        if end < n:
            m = WS.search(text, end)
            end = m.start() if m else n
        yield text[at:end].lower().split()
        at = end


def payloads(col) -> list:
    """Arrow string column -> list of bytes (None stays None)."""
    import pyarrow as pa
    return col.cast(pa.large_binary()).to_pylist()
