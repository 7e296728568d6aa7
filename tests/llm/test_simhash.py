"""SimHash near-duplicates against a brute-force version."""

import random

import numpy as np
import pytest
import xxhash

from quire.llm import simhash as S


def brute_fp(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(rows, bits=3):
    fps = [brute_fp(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= bits and label[j] > label[i]:
                    label[j] = label[i]
                    changed = True
    groups = {}
    for i, lab in enumerate(label):
        groups.setdefault(lab, []).append(rows[i][0])
    return {(rows[i][0], fps[i], min(x for x in groups[lab] if x is not None)) for i, lab in enumerate(label)}


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(60):
        rows.append((i * 3, " ".join(rnd.choice("the a of cat dog tree road sky").upper() + str(rnd.randrange(9))
                                     for _ in range(rnd.randrange(3, 120)))))
    for i in range(40):                                   # near and exact copies
        words = rows[i][1].split()
        if i % 2:
            words[rnd.randrange(len(words))] = "changed"
        rows.append((1000 - i, "  ".join(words)))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "one"), (5004, "ONE"), (5005, "one two"), (5006, "é ü x y")]
    rows += [(5003, "one")]                               # a repeated row
    df = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "doc_id long, text string, fp string, key string")
    got = S.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got} == brute_components(rows)


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text_is_cut_at_white_space_only():
    text = ("word " * 1000 + "longer\tword\n").encode() * 3
    want = text.lower().split()
    assert [w for p in S.word_pieces(text, 100) for w in p] == want
    a = np.concatenate(list(S.shingle_hashes(text, 3)))
    assert len(a) == len(want) - 2
    assert S.text_fingerprints([text], 3)[0] == brute_fp(text.decode())


@pytest.mark.parametrize("group", [1, 4, S.GROUP])
def test_hot_groups_lose_no_link(spark, group):
    rnd = random.Random(group)
    fps = set()
    for c in (0x0123456789ABCDEF, 0xFFFF000012345678):      # dense clusters share most blocks
        for _ in range(150):
            x = c
            for b in rnd.sample(range(40, 52), rnd.randrange(0, 6)):
                x ^= 1 << b
            fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, group).collect()
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for r in edges:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        parent[find(a)] = find(b)
    want = {f: f for f in fps}

    def wfind(x):
        while want[x] != x:
            x = want[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                want[wfind(a)] = wfind(b)
    assert {frozenset(f for f in fps if find(f) == find(r)) for r in fps} == \
        {frozenset(f for f in fps if wfind(f) == wfind(r)) for r in fps}
    if group == S.GROUP:
        assert len(edges) < 10 * len(fps)
