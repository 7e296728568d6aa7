"""Exact top-k search: tiled matrix products, partial selection per tile and
a tree merge of the per-query lists.

Queries are packed into tiles (Parquet in the shared folder).  Groups of tiles
of at most ``GROUP_BYTES`` are broadcast one after another; each scan of the
candidates multiplies every candidate tile with every query tile and keeps a
running list per query, so a task holds one tile product and its lists.  Lists
of different tasks meet in a tree of ``FAN`` lists per step: no task ever sees
more than ``FAN`` short lists of a query.

Scores are exact integers: products run in float64 while every sum is below
2**53, and in Python integers otherwise (a score outside 64 bits raises).

Defined results: null vectors, vectors with a null or non-finite component and
rows with a null id take no part; vectors of different length are compared as
if padded with zeros; a repeated row is one more candidate (only the query's
own row is left out) and one more query; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import stash, table

TILE = 2048                  # rows of a query or candidate tile
GROUP_BYTES = 64 << 20       # query tiles broadcast together
FAN = 16                     # lists merged in one step


def quantised(ids, vectors, scale: float):
    """Ids and integer-valued float64 matrix of the rows that take part."""
    import pyarrow as pa
    ok = ~np.asarray(vectors.is_null()) & ~np.asarray(ids.is_null())
    lens = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False)           # nulls become NaN
    bad = np.zeros(len(lens) + 1, dtype=np.int64)
    ends = np.cumsum(lens)
    if len(x):
        bad[1:] = np.concatenate(([0], np.cumsum(~np.isfinite(x))))[ends]
    ok &= np.diff(bad) == 0
    dim = int(lens[ok].max()) if ok.any() else 0
    out = np.zeros((int(ok.sum()), dim))
    rows, begin, n = np.flatnonzero(ok), (ends - lens)[ok], lens[ok]
    if dim and (n == dim).all():
        out[:] = x[begin[:, None] + np.arange(dim)]
    else:
        for i in range(len(rows)):
            out[i, :n[i]] = x[begin[i]:begin[i] + n[i]]
    return ids.to_numpy(zero_copy_only=False)[rows].astype(np.int64), np.floor(scale * out)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact int64 inner products of two integer-valued matrices."""
    d = min(q.shape[1], c.shape[1])
    q, c = q[:, :d], c[:, :d]
    if not d or not len(q) or not len(c):
        return np.zeros((len(q), len(c)), dtype=np.int64)
    if np.abs(q).sum(axis=1).max() * np.abs(c).max() < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    big = np.frompyfunc(int, 1, 1)
    return (big(q) @ big(c).T).astype(np.int64)       # OverflowError beyond 64 bits


def best(scores: np.ndarray, ids: np.ndarray, k: int):
    """Per row the ``k`` entries of highest score, ties to the smaller id, in
    order; ``ids`` has the shape of ``scores`` or of one row."""
    m = scores.shape[1]
    ids = np.broadcast_to(ids, scores.shape)
    if m > k:
        kth = np.partition(scores, m - k, axis=1)[:, m - k]
        above, ties = scores > kth[:, None], scores == kth[:, None]
        spare = k - above.sum(axis=1)
        many = np.flatnonzero(ties.sum(axis=1) > spare)
        for r in many:                                # more ties than places: smallest ids
            at = np.flatnonzero(ties[r])
            ties[r, at[np.argsort(ids[r, at], kind="stable")[spare[r]:]]] = False
        take = np.nonzero(above | ties)[1].reshape(len(scores), k)
        scores, ids = np.take_along_axis(scores, take, 1), np.take_along_axis(ids, take, 1)
    order = np.lexsort((ids, -scores), axis=1)
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def query_tiles(rows: DataFrame, scale: float) -> DataFrame:
    """``tile string, n int, dim int, ids binary, mat binary`` of the queries."""
    import pyarrow as pa

    def run(batches):
        from pyspark import TaskContext
        part, i = TaskContext.get().partitionId(), 0
        for b in batches:
            ids, mat = quantised(b.column(0), b.column(1), scale)
            for s in range(0, len(ids), TILE):
                x = mat[s:s + TILE]
                yield pa.RecordBatch.from_pylist([{
                    "tile": f"{part}-{i}", "n": len(x), "dim": x.shape[1],
                    "ids": ids[s:s + TILE].tobytes(), "mat": x.tobytes()}],
                    schema=pa.schema([("tile", pa.string()), ("n", pa.int32()), ("dim", pa.int32()),
                                      ("ids", pa.binary()), ("mat", pa.binary())]))
                i += 1

    return rows.mapInArrow(run, "tile string, n int, dim int, ids binary, mat binary")


def _scan(cand: DataFrame, tiles, k: int, scale: float) -> DataFrame:
    """Running lists of every task: one row per query and task."""
    import pyarrow as pa
    entry = pa.struct([("neg", pa.int64()), ("vec_id", pa.int64())])
    schema = pa.schema([("q", pa.string()), ("query_id", pa.int64()), ("own", pa.int64()), ("shard", pa.int32()),
                        ("top", pa.list_(entry))])

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        queries = []
        for t in tiles.value:
            ids, mat = np.frombuffer(t.ids, np.int64), np.frombuffer(t.mat).reshape(t.n, t.dim)
            queries.append([t.tile, ids, mat, None, None])
        for b in batches:
            cid, cm = quantised(b.column(0), b.column(1), scale)
            for s in range(0, len(cid), TILE):
                c, ci = cm[s:s + TILE], cid[s:s + TILE]
                for q in queries:
                    sc = products(q[2], c)
                    ids = np.broadcast_to(ci, sc.shape)
                    if len(ci) > k + 1:
                        sc, ids = best(sc, ids, k + 1)
                    if q[3] is not None:
                        sc, ids = np.hstack([q[3], sc]), np.hstack([q[4], ids])
                    q[3], q[4] = best(sc, ids, k + 1)
        for tile, ids, mat, sc, near in queries:
            if sc is None:
                continue
            m = sc.shape[1]
            own = np.array([products(r[None], r[None])[0, 0] for r in mat], dtype=np.int64)
            for s in range(0, len(ids), 1024):
                e = min(s + 1024, len(ids))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(e - s + 1) * m, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(-sc[s:e].ravel()), pa.array(near[s:e].ravel())],
                                               fields=list(entry)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{tile}-{i}" for i in range(s, e)]), pa.array(ids[s:e]), pa.array(own[s:e]),
                    pa.array([part] * (e - s), pa.int32()), lists.cast(schema.field("top").type)], schema=schema)

    return cand.mapInArrow(run, "q string, query_id bigint, own bigint, shard int, "
                                "top array<struct<neg:bigint,vec_id:bigint>>")


def merge(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """Tree merge: ``FAN`` lists of a query at a time until one is left."""
    while shards > 1:
        shards = -(-shards // FAN)
        lists = (lists.groupBy("q", "query_id", "own", F.floor(F.col("shard") / FAN).cast("int").alias("shard"))
                      .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k + 1).alias("top")))
    return lists


def top_k(rows: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding",
          scale: float = 64.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row meeting ``is_query``
    the ``k`` other rows of highest integer inner product."""
    spark = rows.sparkSession
    narrow = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("embedding"), is_query.alias("_q"))
    cand = narrow.select("vec_id", "embedding")
    tiles = stash(query_tiles(narrow.where("_q").select("vec_id", "embedding"), scale), "tiles")
    shards = cand.rdd.getNumPartitions()
    sizes = tiles.select("tile", (F.length("mat") + F.length("ids")).alias("b")).orderBy("tile").toLocalIterator()
    groups, held = [[]], 0
    for r in sizes:                                    # names of tiles only
        if groups[-1] and held + r.b > GROUP_BYTES:
            groups.append([])
            held = 0
        groups[-1].append(r.tile)
        held += r.b
    out = None
    for names in groups:
        one = tiles.where(F.col("tile").isin(names)).collect() if names else []      # at most GROUP_BYTES
        lists = merge(_scan(cand, spark.sparkContext.broadcast(one), k, scale), shards, k)
        if len(groups) > 1:
            lists = stash(lists, "topk")
        out = lists if out is None else out.unionByName(lists)
    own = F.array_position("top", F.struct((-F.col("own")).alias("neg"), F.col("query_id").alias("vec_id")))
    kept = F.slice(F.filter("top", lambda e, i: i + 1 != F.col("_own")), 1, k)
    return (out.withColumn("_own", own).select("query_id", F.posexplode(kept).alias("_i", "_e"))
               .select("query_id", (F.col("_i") + 1).cast("int").alias("rank"), F.col("_e.vec_id").alias("vec_id"),
                       (-F.col("_e.neg")).alias("score")))


def op10_exact_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
