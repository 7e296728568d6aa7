"""Writers (B1-B7).  Parquet is the internal format; text writers exist to
exchange files with tools that expect the source scripts' formats."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from quire.functions.text import py_strip
from quire.operators.order import bucket_column, running_offset


def page_dump_value(url: str = "url", html: str = "html", marker: str = "---ENDDOC---"):
    """B1: ``URL: u⏎<html>⏎…⏎</html>⏎---ENDDOC---``; a null url or page counts as empty."""
    u, h = (F.coalesce(F.col(c), F.lit("")) for c in (url, html))
    return F.concat(F.lit("URL: "), u, F.lit("\n<html>\n"), h, F.lit("\n</html>\n" + marker))


def sentinel_value(text: str = "text", marker: str = "---ENDDOC---"):
    """B2: stripped text followed by the marker line (empty texts too)."""
    return F.concat(py_strip(F.coalesce(F.col(text), F.lit(""))), F.lit("\n" + marker))


def write_text(df: DataFrame, path: str, order: str | None = None, partition_by=None,
               mode: str = "overwrite") -> None:
    """One line per row; ``order`` sorts inside each output file
    (range-partitioned first so files follow the order), ``partition_by``
    gives one folder per split/shard."""
    cols = [c for c in df.columns]
    out = df
    if order:
        out = out.repartitionByRange(order).sortWithinPartitions(order)
    keep = [c for c in cols if c == "value" or (partition_by and c in partition_by)]
    w = out.select(*keep).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


def write_shards(df: DataFrame, path: str, prefix: str, shard: str = "shard", order: str | None = None,
                 suffix: str = ".seq") -> list[str]:
    """One text file ``<prefix><shard><suffix>`` per shard (the format
    asks for one file each, written by one task each); returns the paths."""
    x = df.repartition(shard)
    x = x.sortWithinPartitions(shard, order) if order else x
    tmp = path.rstrip("/") + "/_shards"
    x.select(shard, "value").write.partitionBy(shard).text(tmp)
    jvm = df.sparkSession._jvm
    root = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = root.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    out = []
    for folder in fs.listStatus(root):                       # one folder per shard
        name = folder.getPath().getName()
        if not name.startswith(shard + "="):
            continue
        parts = [p.getPath() for p in fs.listStatus(folder.getPath()) if p.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"{name} has {len(parts)} files")
        to = jvm.org.apache.hadoop.fs.Path(path, prefix + name.split("=", 1)[1] + suffix)
        if not fs.rename(parts[0], to):
            raise RuntimeError(f"cannot rename {parts[0]}")
        out.append(to.toString())
    fs.delete(root, True)
    return sorted(out)


FILE_BYTES = 256 << 20
MANIFEST = "ord long, shard string, number int, file string"


def write_shard_files(df: DataFrame, path: str, prefix: str, shard: str = "shard", order: str = "seq_id",
                      max_bytes: int | None = None) -> int:
    """B5 for shards of any size: every shard as files numbered in ``order``, each
    about ``max_bytes`` long (default: 256 MiB, less if that would leave cores
    without a file) and written by a task of its own.  Returns the number of files.

    A narrow pass over lengths gives the first key of every file (one row per
    file on the driver, as many as a listing of them has); the lines then move
    once.  Rows of equal ``order`` share a file, a null ``order`` comes first, a
    null shard is an error.  The files of a run lie in a folder of their own;
    ``<prefix>.manifest``, written last, names them in order, so a reader sees
    the old run or the new one.  ``df`` is read several times: store what is
    costly to compute."""
    spark = df.sparkSession
    keys = df.select(shard, order, (F.octet_length("value") + 1).cast("bigint").alias("_b"))
    st = keys.agg(F.coalesce(F.sum("_b"), F.lit(0)).alias("b"), F.count_if(F.col(shard).isNull()).alias("bad")).first()
    if st["bad"]:
        raise ValueError(f"{st['bad']} rows without a shard")
    if max_bytes is None:
        max_bytes = min(FILE_BYTES, max(1, -(-st["b"] // spark.sparkContext.defaultParallelism)))
    keys = running_offset(keys, [order], "_b", out="_at", group=[shard])
    cuts = keys.groupBy(shard, F.floor(F.col("_at") / F.lit(max_bytes)).alias("_n")).agg(F.min(order).alias("_k")).collect()
    bounds = []                                            # (shard, first key), one per file
    for r in sorted(cuts, key=lambda r: (r[shard], r["_n"])):
        if not bounds or bounds[-1][0] != r[shard]:
            bounds.append((r[shard], None))                # from the nulls on
        elif r["_k"] is not None and r["_k"] != least:
            bounds.append((r[shard], r["_k"]))
        least = r["_k"]
    run = f"{prefix}-{uuid.uuid4().hex}"
    if not bounds:                                         # no rows: a manifest without files
        (spark.createDataFrame([], MANIFEST).coalesce(1)
              .write.mode("overwrite").json(f"{path.rstrip('/')}/{prefix}.manifest"))
        return 0
    name = F.lpad(bucket_column(df, [shard, order], bounds[1:]).cast("string"), 10, "0")
    (df.select("value", order, name.alias("file")).repartition(len(bounds), "file")
       .sortWithinPartitions("file", order).select("value", "file")
       .write.partitionBy("file").text(f"{path.rstrip('/')}/{run}"))
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{run}/file=*/part-*")
    found = sorted(f.getPath().toString() for f in
                   pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern))
    if len(found) != len(bounds):
        raise RuntimeError(f"{len(found)} files for {len(bounds)} ranges")
    rows, n = [], 0
    for i, (file, (part, _)) in enumerate(zip(found, bounds)):
        n = n + 1 if i and bounds[i - 1][0] == part else 0
        rows.append((i, str(part), n, "/".join(file.split("/")[-3:])))
    (spark.createDataFrame(rows, MANIFEST).coalesce(1)
          .write.mode("overwrite").json(f"{path.rstrip('/')}/{prefix}.manifest"))
    return len(rows)
