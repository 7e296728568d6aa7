"""Whitening against exact arithmetic and numpy's eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from quire.llm import whiten as W

SCHEMA = "vec_id long, embedding array<float>, clash int, v int, n string"


def plain(rows):
    """{id: x} of the rows that take part, exact deviation per row, covariance."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in ok]
    n, s = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    y = [[Fraction(a * n - b, n) for a, b in zip(r, s)] for r in x]
    cov = [[float(sum(r[i] * r[j] for r in y) / n) for j in range(len(s))] for i in range(len(s))]
    return [i for i, _ in ok], dev, np.array([[float(c) for c in r] for r in y]), np.array(cov)


def run(spark, rows, tmp_path, parts=7):
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA).repartition(parts)
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    return W.op12_embedding_whitening(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("dim", [3, 40])
def test_against_plain_version(spark, tmp_path, dim):
    rng = np.random.default_rng(dim)
    mix = rng.normal(size=(dim, dim))
    rows = [(i, (rng.normal(size=dim) @ mix).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200, None), (201, [float("nan")] * dim), (202, [float("inf")] * dim), (203, [None] + [0.5] * (dim - 1)), (204, []),
             (205, [1.0]), (7, rows[3][1]), (None, rows[4][1])]
    usable = [r for r in rows if r[1] is not None and len(r[1]) == dim]
    ids, dev, y, cov = plain(usable)
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    got = run(spark, rows, tmp_path)
    k = min(dim, W.COMPONENTS)
    assert len(got) == len(ids) * k
    assert {r.n for r in got} == {len(ids)} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    want = sorted((i is None, i or 0, d, c + 1, *[round(abs(float(t)), 6)])
                  for i, d, r in zip(ids, dev, y) for c, t in enumerate((r @ q / np.sqrt(e))[:k]))
    have = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.component, round(abs(r.whitened), 6)) for r in got)
    for a, b in zip(want, have):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-5
    for r in got:
        assert math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-9)


def test_tree_merge_and_one_sign_for_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "FAN", 2)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    got = run(spark, rows, tmp_path, parts=11)
    w = np.zeros((60, 4))
    for r in got:
        w[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(w.T @ w / 60 - np.eye(4)).max() < 1e-9 and np.abs(w.mean(axis=0)).max() < 1e-9


def test_no_variance_one_row_none_and_huge_entries(spark, tmp_path):
    one = run(spark, [(1, [0.25, 0.5])], tmp_path / "a")
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    assert run(spark, [(1, None)], tmp_path / "b") == []
    flat = run(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(8)], tmp_path / "c")      # rank one
    assert all(r.whitened == 0 for r in flat if r.component > 1) and any(r.whitened for r in flat if r.component == 1)
    big = run(spark, [(0, [3e38, 1.0]), (1, [-3e38, 2.0]), (2, [1e37, 0.0])], tmp_path / "d")
    assert len(big) == 6 and {r.deviation for r in big} == {None}


def matrices():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    yield np.zeros((4, 4))
    yield np.eye(5) * 3
    yield np.diag([1.0, 1, 2, 2, 2, 3])
    yield (q * np.logspace(0, -18, 30)) @ q.T
    yield (q * np.repeat([1, 5, 5.0000000001], 10)) @ q.T
    a = rng.normal(size=(5, 30))
    yield a.T @ a
    a = rng.normal(size=(200, 100))
    yield a.T @ a * 1e30


@pytest.mark.parametrize("v", list(matrices()))
def test_spectrum(v):
    e, q = W.spectrum(v)
    size = max(np.abs(v).max(), 1e-300)
    assert np.abs(e - np.linalg.eigvalsh((v + v.T) / 2)[::-1]).max() <= 1e-12 * size * len(v)
    assert np.abs(q.T @ q - np.eye(len(v))).max() < 1e-12
    assert np.abs(v @ q - q * e).max() <= 1e-12 * size * len(v)


def test_polar_factor():
    a = np.diag([2.0, 1e-9, -3.0, -1e-12])
    assert np.abs(W.polar(a) - np.diag([1, 1, -1, -1])).max() < 1e-9
