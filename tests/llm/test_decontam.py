"""Decontamination against a brute-force comparison of all windows."""

import random
from collections import Counter

import numpy as np
import pytest

from quire.llm import decontam as D


def grams(words, k=5):
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def sim(a, b):
    inter = sum((a & b).values())
    return inter / (sum(a.values()) + sum(b.values()) - inter)


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = (t or "").lower().split()
        for i, it in items:
            v = (it or "").lower().split()
            if not v or not w:
                continue
            if len(v) < 5:
                if v == w:
                    out[d, i] = 1.0
                continue
            n = min(len(v), len(w))
            if n < 5:
                continue
            s = max(sim(grams(w[j:j + n]), grams(v)) for j in range(len(w) - n + 1))
            if s >= 0.8:
                out[d, i] = s
    return out


def case():
    rnd = random.Random(4)
    pool = [f"w{i}" for i in range(40)]
    words = lambda n: [rnd.choice(pool) for _ in range(n)]
    items = [(i, " ".join(words(rnd.randrange(8, 60)))) for i in range(25)]
    items += [(50, "only three words"), (51, ""), (52, None), (53, "a b a b a b a b a b a b a b")]
    docs = []
    for i in range(120):
        w = words(rnd.randrange(0, 150))
        it = items[i % 25][1].split()
        if i % 3 == 0:
            it = list(it)
            for _ in range(rnd.randrange(0, 3)):                 # a near copy
                j = rnd.randrange(len(it))
                it[j:j + 1] = rnd.choice([[], ["other"], [it[j], "more"]])
            at = rnd.randrange(len(w) + 1)
            w[at:at] = it
        elif i % 3 == 1:
            w += it[:len(it) // 2]                               # half an item stays clean
        docs.append((i, "  ".join(w).upper() if i % 2 else "\n".join(w)))
    docs += [(200, "Only THREE\twords"), (201, "only three words more"), (202, None), (203, ""),
             (204, items[3][1].rsplit(" ", 1)[0]), (205, "a b " * 40), (206, " ".join(words(3000)) + " " + items[7][1])]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = case()
    d = spark.createDataFrame([(*r, 9, "s") for r in docs], "doc_id long, text string, item_id int, m string")
    b = spark.createDataFrame([(*r, 1.0) for r in items], "item_id long, text string, similarity double")
    got = D.contaminated(d, b).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(got) == len(want) and any(v < 1 for v in want.values())
    kept = {r.doc_id for r in D.decontaminate(d, b).collect()}
    assert kept == {i for i, _ in docs} - {k[0] for k in want}


def test_parts_of_a_large_benchmark_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(D, "PART_BYTES", 700)
    docs, items = case()
    d = spark.createDataFrame(docs[:60] + docs[:3], "doc_id long, text string")
    b = spark.createDataFrame(items + items[:5], "item_id long, text string")
    assert len(list(D.parts(b))) > 3
    got = [(r.doc_id, r.item_id) for r in D.contaminated(d, b).collect()]
    want = brute(docs[:60], items)
    assert set(got) == set(want) and len(got) == len(want) + len([k for k in want if k[0] < 3])


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contaminated(d.limit(0), b).count() == 0 and D.contaminated(d, b.limit(0)).count() == 0
    assert D.decontaminate(d, b.limit(0)).count() == 1 and D.decontaminate(d, b).count() == 0


def test_index_finds_every_fingerprint_within_the_radius():
    rnd = np.random.default_rng(1)
    it = D.Items([(i, (f"x{i} " * 9).encode()) for i in range(60)])
    fps = rnd.integers(0, 1 << 63, 300, dtype=np.uint64)
    for j in range(200):                                        # plant near ones
        f = int(it.items[j % 60][3])
        for b in rnd.choice(64, rnd.integers(0, 30), replace=False):
            f ^= 1 << int(b)
        fps[j] = f
    got = {(w, i) for w, i, _ in it.within(fps, 9)}
    want = {(w, i) for w in range(300) for i in range(60) if (int(fps[w]) ^ int(it.items[i][3])).bit_count() <= D.RADIUS}
    assert got == want and len(want) > 100
    with pytest.raises(ValueError):
        D.Items([], radius=24)
