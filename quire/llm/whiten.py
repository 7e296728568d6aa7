"""Embedding whitening by QDWH spectral divide-and-conquer.

Vectors are quantised to whole numbers ``x = floor(scale * c) + shift``.  One
pass counts them and sums them exactly; a second one sums the products of the
centred vectors.  The covariance (dimensions x dimensions, ``MAX_DIM`` at
most) is split on the driver: the polar factor U of ``A - mu I``, found by the
QR-based dynamically weighted Halley iteration, has the eigenvalues +1 and -1
on the invariant subspaces above and below ``mu``, so ``(U + I) / 2`` projects
on the upper one.  Its range and its complement are split in the same way
until a subspace is a single component (or one eigenvalue within rounding).
The components are broadcast and every vector is whitened in one pass; a pass
before it measures the covariance of the whitened vectors.

Partial results of the tasks (a count, exact sums, one matrix) meet in a tree
of ``FAN`` per step, so the driver gets ``FAN`` of them at most.

Defined results: null vectors, vectors with a null or non-finite entry, empty
ones and those of another length than most (the longest of equally frequent
lengths counts) are dropped; null ids and repeated rows stay; quantised values
are cut to +-2**61; a component whose eigenvalue is not above
``dimensions * 2.2e-16`` of the largest has no direction in the data: its
``whitened`` is 0 and it takes no part in ``identity_error``; ``explained`` is
0 when the trace is; an empty table gives no rows.  ``deviation`` is exact
(null beyond 38 digits).
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quire.llm.base import table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
MAX_DIM = 4096               # the covariance takes 8 * MAX_DIM ** 2 bytes on the driver
FAN = 16                     # partial results merged in one step
STEP = 4096                  # vectors worked on at a time
LIMIT = float(1 << 61)
EPS = float(np.finfo(float).eps)


# ---- linear algebra of one small symmetric matrix -------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix (QDWH)."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    low = max(1.0 / np.linalg.norm(np.linalg.pinv(x)), 1e-17)       # a lower bound of the smallest singular value
    low = min(low, 1.0)
    eye = np.eye(n)
    for _ in range(20):
        d = np.cbrt(4 * (1 - low ** 2) / low ** 4)
        h = np.sqrt(1 + d) + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * np.sqrt(1 + d)), 0.0))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        new = (b / c) * x + (h - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (h + b * low ** 2) / (1 + c * low ** 2))
        if moved < 1e-9 * np.sqrt(n) and 1 - low < 1e-9:       # the iteration is cubic: the next step would be exact
            break
    return x


def subspaces(a: np.ndarray, mu: float):
    """Bases of the invariant subspaces above and below ``mu``; None when
    ``mu`` hits an eigenvalue or splits nothing."""
    n = len(a)
    p = (polar(a - mu * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(np.trace(p)))
    if not 0 < rank < n or np.linalg.norm(p @ p - p) > 1e-8:
        return None
    # subspace iteration on the projector: one step from its dominant columns, one to clean up
    order = np.argsort(-np.linalg.norm(p, axis=0), kind="stable")
    picked, rest = [], p[:, order].copy()
    for _ in range(rank):                                    # pivoted Gram-Schmidt: the columns that span the range
        j = int(np.argmax(np.einsum("ij,ij->j", rest, rest)))
        v = rest[:, j] / np.linalg.norm(rest[:, j])
        picked.append(v)
        rest -= np.outer(v, v @ rest)
    q, _ = np.linalg.qr(p @ np.array(picked).T)
    full, _ = np.linalg.qr(np.hstack([q, np.eye(n) - p]))
    return full[:, :rank], full[:, rank:n]


def spectrum(v: np.ndarray):
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric
    matrix, by recursive splitting with spectral projectors."""
    n = len(v)
    a = (v + v.T) / 2
    size = np.linalg.norm(a)
    found = []
    todo = [np.eye(n)]
    while todo:
        basis = todo.pop()
        m = basis.shape[1]
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        mid = np.trace(part) / m
        if m == 1 or np.linalg.norm(part - mid * np.eye(m)) <= 4 * EPS * size:
            found.extend(basis.T)                            # one eigenvalue within rounding
            continue
        diag = np.sort(np.diag(part))
        spread = np.linalg.norm(part - mid * np.eye(m)) / np.sqrt(m)
        tries = [np.median(diag), mid] + [mid + f * spread for f in (0.1, -0.1, 0.37, -0.37, 0.73, -0.73, 0.02, -0.02)]
        for mu in tries:
            got = subspaces(part, mu)
            if got is not None:
                todo += [basis @ got[0], basis @ got[1]]
                break
        else:
            raise ArithmeticError("no shift separates the spectrum")
    q, _ = np.linalg.qr(np.array(found).T)
    e = np.einsum("ij,ij->j", q, a @ q)
    order = np.argsort(-e, kind="stable")
    return e[order], q[:, order]


# ---- passes over the vectors ----------------------------------------------

def _usable(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """``id, v``: rows without null or non-finite entries."""
    x = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))) & ~F.isnan(c))
    return x.where(F.col("v").isNotNull() & (F.size("v") > 0) & whole)


def _matrix(col, dim: int, scale: float, shift: int) -> np.ndarray:
    """Quantised vectors of an Arrow list column, int64."""
    c = col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * c) + shift, -LIMIT, LIMIT).astype(np.int64)


def _merged(parts: DataFrame, merge) -> list:
    """Partial results (a column ``b`` of bytes) merged in a tree until at
    most ``FAN`` are left, which go to the driver."""
    import pyarrow as pa

    def run(batches):
        held = None
        for b in batches:
            for x in b.column(0).to_pylist():
                held = x if held is None else merge(held, x)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.large_binary())], names=["b"])

    n = parts.rdd.getNumPartitions()
    while n > FAN:
        n = -(-n // FAN)
        parts = parts.repartition(n).mapInArrow(run, "b binary")
    out = None
    for r in parts.collect():
        out = bytes(r.b) if out is None else merge(out, bytes(r.b))
    return out


def _sums(x: DataFrame, dim: int, scale: float, shift: int):
    """Exact count and sums per dimension."""
    import pyarrow as pa

    def run(batches):
        n, s = 0, [0] * dim
        for b in batches:
            m = _matrix(b.column(0), dim, scale, shift)
            high, low = (m >> 31).sum(axis=0), (m & (1 << 31) - 1).sum(axis=0)      # neither can overflow
            s = [a + (int(h) << 31) + int(l) for a, h, l in zip(s, high, low)]
            n += len(m)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps([n, s]).encode()], pa.binary())], names=["b"])

    def merge(p, q):
        (n, s), (m, t) = json.loads(p), json.loads(q)
        return json.dumps([n + m, [a + b for a, b in zip(s, t)]]).encode()

    got = _merged(x.select("v").mapInArrow(run, "b binary"), merge)
    return json.loads(got) if got else [0, [0] * dim]


class Centre:
    """x - S/n without cancellation: the nearest whole numbers are taken off
    as integers, the rests (at most a half) as doubles."""

    def __init__(self, n: int, s: list):
        self.whole = np.array([(2 * a + n) // (2 * n) for a in s], dtype=np.int64)
        self.rest = np.array([(a - int(w) * n) / n for a, w in zip(s, self.whole)])

    def __call__(self, m: np.ndarray) -> np.ndarray:
        return (m - self.whole) - self.rest


def _moments(x: DataFrame, dim: int, scale: float, shift: int, centre: Centre, axes=None) -> np.ndarray:
    """Sum of the products of the centred vectors, or of their coordinates on
    ``axes``; centred once more with the sums of the part (Chan's rule)."""
    import pyarrow as pa
    k = dim if axes is None else axes.shape[1]

    def join(n, mean, m2, n2, mean2, m22):
        if not n2:
            return n, mean, m2
        d = mean2 - mean
        return n + n2, mean + d * (n2 / (n + n2)), m2 + m22 + np.outer(d, d) * (n * n2 / (n + n2))

    def pack(n, mean, m2):
        return np.concatenate(([float(n)], mean, m2.ravel())).tobytes()

    def unpack(b):
        a = np.frombuffer(b)
        return a[0], a[1:1 + k], a[1 + k:].reshape(k, k)

    def run(batches):
        state = 0.0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            m = _matrix(b.column(0), dim, scale, shift)
            for i in range(0, len(m), STEP):
                y = centre(m[i:i + STEP])
                y = y if axes is None else y @ axes
                mean = y.mean(axis=0)
                y -= mean
                state = join(*state, float(len(y)), mean, y.T @ y)
        yield pa.RecordBatch.from_arrays([pa.array([pack(*state)], pa.large_binary())], names=["b"])

    got = _merged(x.select("v").mapInArrow(run, "b binary"), lambda p, q: pack(*join(*unpack(p), *unpack(q))))
    n, _, m2 = unpack(got)
    return m2 / n


def fit(x: DataFrame, dim: int, scale: float = SCALE, shift: int = SHIFT) -> dict | None:
    """Count, exact sums, eigenvalues and components of the usable rows."""
    if dim > MAX_DIM:
        raise ValueError(f"vectors of more than {MAX_DIM} entries")
    n, s = _sums(x, dim, scale, shift)
    if not n:
        return None
    centre = Centre(n, s)
    v = _moments(x, dim, scale, shift, centre)
    e, q = spectrum(v)
    trace = float(np.trace(v))
    live = e > dim * EPS * max(float(e[0]), 0.0)
    axes = np.where(live, q / np.sqrt(np.where(live, e, 1.0)), 0.0)
    return {"n": n, "sums": s, "centre": centre, "values": e, "axes": axes, "live": live,
            "explained": np.maximum(e, 0.0) / trace if trace > 0 else np.zeros(dim)}


def deviations(m: np.ndarray, n: int, s: list) -> list:
    """Sum over dimensions of (n * x - S) ** 2, exact."""
    low = np.array([a // n for a in s], dtype=np.int64)              # n * x - S = n * (x - low) - rest
    rest = np.array([a - int(f) * n for a, f in zip(s, low)], dtype=np.int64)
    d = m - low
    top = (int(np.abs(d).max()) + 1) * n if len(d) else 0
    if top * top * m.shape[1] < 1 << 63:
        d = n * d - rest
        return (d * d).sum(axis=1).tolist()
    big = np.frompyfunc(int, 1, 1)
    d = n * big(d) - big(rest)
    return (d * d).sum(axis=1).tolist()


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: float = SCALE, shift: int = SHIFT) -> DataFrame:
    """``id, n, deviation, whitened`` (array, ``components`` entries at most),
    ``explained`` (array) and ``identity_error`` per usable row."""
    import pyarrow as pa
    from decimal import Decimal
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[key]
    x = _usable(rows, vector, key)
    most = x.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    ddl = f"id {kind}, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if most is None:
        return spark.createDataFrame([], ddl)
    dim = most["dim"]
    x = x.where(F.size("v") == dim)
    model = fit(x, dim, scale, shift)
    k = min(components, dim)
    axes, live = model["axes"][:, :k], model["live"][:k]
    cov = _moments(x, dim, scale, shift, model["centre"], axes)
    wrong = np.abs(cov - np.eye(k))[np.ix_(live, live)]
    error = float(wrong.max()) if wrong.size else 0.0
    shared = spark.sparkContext.broadcast((model["n"], model["sums"], axes, model["explained"][:k].tolist()))

    def run(batches):
        n, s, axes, explained = shared.value
        centre = Centre(n, s)
        top = 10 ** 38
        for b in batches:
            for i in range(0, b.num_rows, STEP):
                part = b.slice(i, STEP)
                m = _matrix(part.column(1), dim, scale, shift)
                w = centre(m) @ axes
                rows = len(m)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.full(rows, n)),
                    pa.array([Decimal(d) if d < top else None for d in deviations(m, n, s)], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * k, w.ravel()),
                    pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * k, np.tile(explained, rows)),
                    pa.array(np.full(rows, error))],
                    names=["id", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, ddl)


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """A row per vector and component; ``deviation`` is null where it exceeds
    a long."""
    w = whiten(table(spark, sf_dir, "embeddings"))
    x = w.select("id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "identity_error",
                 F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "c"))
    return x.select(F.col("id").alias("vec_id"), (F.col("i") + 1).alias("component"), "n", "deviation",
                    F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
