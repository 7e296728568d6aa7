"""Session helpers: sane defaults and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Catalyst infers ``size(arr) > 0`` from ``explode(arr)`` and pushes it below
# the projection that builds ``arr``; with a lambda-built array (shingles,
# word pairs) that re-evaluates the whole array per element.  Excluding the
# rule keeps one evaluation per row.
EXCLUDED_RULES = "org.apache.spark.sql.catalyst.optimizer.InferFiltersFromGenerate"


def build_session(master: str | None = None, app: str = "quire", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    parts = shuffle_partitions or int(os.environ.get("QUIRE_SHUFFLE_PARTITIONS", "8"))
    conf = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("QUIRE_DRIVER_MEMORY", "8g"),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.optimizer.excludedRules": EXCLUDED_RULES,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the optimizer exclusion to a session created elsewhere."""
    cur = spark.conf.get("spark.sql.optimizer.excludedRules", "") or ""
    if EXCLUDED_RULES not in cur:
        spark.conf.set("spark.sql.optimizer.excludedRules",
                       ",".join(x for x in (cur, EXCLUDED_RULES) if x))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``; that value is used as is.
    Only a local-mode session without it (tests, the laptop) gets a fresh
    folder under the system temp directory.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df, tag: str = "store"):
    """``df`` as compressed Parquet in the shared folder, read back: like
    :func:`materialize`, but a later step reads only the columns it names."""
    import uuid
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df, rows: int, max_bytes: int = 64 << 20) -> bool:
    """Is ``df`` small enough to broadcast?  At most ``rows`` rows and
    ``max_bytes`` bytes of strings and eight bytes per other column; the check
    reads no more than ``rows + 1`` rows."""
    from pyspark.sql import functions as F
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(8) for c, t in df.dtypes), F.lit(16))
    r = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return r["n"] <= rows and r["b"] <= max_bytes


def spread(df):
    """Use every core when a scan yields fewer splits than the cluster has
    task slots (one small file = one task).  At scale, scans produce far more
    splits than slots and this is a no-op, so it never adds a shuffle there."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df
