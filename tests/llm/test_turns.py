"""Conversation repair against a search over all edits, row by row."""

import hashlib
import random
import sys
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import functions as F

from quire.llm import turns as T

sys.setrecursionlimit(20_000)        # the search takes one call per row and edit
WS = " \t\n\v\f\r"


def faults(rows):
    """Rows (conv, turn, role, text) of one conversation after damage, in order."""
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if f == 0:
            continue
        x = "" if f == 1 else "".join(ch for ch in x if ch not in ".!?") if f == 2 else x
        out += [(t, "user" if f == 4 else r, x)] * (2 if f == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}:{r[2]}".encode()).hexdigest()))


def plain(rows):
    rows = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    kinds, seen = [], set()
    for _, r, x in rows:
        core = x.strip(WS)
        kinds.append("blank" if not core else "duplicate" if (r, x) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((r, x))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    # the smallest (cost, audit) over all edits, by the roles given so far
    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, ""))
        target = "a" if state == "u" else "u"
        if inserted < 3:
            c, a = best(i, target, inserted + 1)
            options.append((2 + c, "I" + a))
        if i < len(rows):
            k, initial = kinds[i], rows[i][1][:1]
            c, a = best(i + 1, state, 0)
            options.append((3 + c, "D" + a))
            if k not in ("blank", "duplicate"):
                late = k == "truncated"
                c, a = best(i + 1, target, 0)
                options.append((2 + late + c, "R" + a))
                if initial == target or initial == "s" and state == "":
                    c, a = best(i + 1, initial, 0)
                    options.append((late + c, "K" + a))
        return min(options, default=(10 ** 9, "~"))

    cost, audit = best(0, "", 0)
    out, at, state = [], iter(rows), ""
    for c in audit:
        target = "a" if state == "u" else "u"
        name = {"a": "assistant", "u": "user"}[target]
        if c == "I":
            out.append(name + ":")
            state = target
            continue
        _, r, x = next(at)
        if c == "K":
            out.append(f"{r}:{x}")
            state = r[:1]
        elif c == "R":
            out.append(f"{name}:{x}")
            state = target
    return (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def table(n, seed):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "sys", "unicorn"]
    texts = ["Hello.", "Why?", "no end", "", "  \n", "Yes!", "x.\t ", None, "é!", "done.  "]
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 9)):
            turn = None if rnd.random() < 0.05 else t + (rnd.random() < 0.1) * rnd.randint(1, 3)
            rows.append((c, turn, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"text {rnd.random()}" + rnd.choice([".", "!", ""])))
    return rows


def check(spark, rows, parts=5):
    df = spark.createDataFrame([r + (1, "k") for r in rows], "conv_id long, turn long, role string, text string, n int, tie string")
    got = {r.conv_id: tuple(r)[1:] for r in T.repair(T.damage(df.repartition(parts))).collect()}
    by: dict = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert got.keys() == by.keys()
    for c, part in by.items():
        assert got[c] == plain(part), (c, part)


def test_against_search(spark):
    rows = table(250, 1) + [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (1 << 40, None, "user", "x."), (1 << 40, None, "user", "y.")]
    rows += [r for r in rows if r[0] == 3]                                     # repeated rows
    rows += [(900, -(1 << 63), "user", "a."), (900, (1 << 63) - 1, "assistant", "b.")]
    by = [r for r in rows if r[0] != 900]
    check(spark, by)
    df = spark.createDataFrame(rows[-2:], "conv_id long, turn long, role string, text string")
    assert T.repair(T.damage(df)).first().gaps in (0, T.LONG)


def test_conversations_over_many_blocks_and_tasks(spark, monkeypatch):
    """One conversation holds most rows; blocks of a few turns."""
    monkeypatch.setattr(T, "BLOCK", 40)
    monkeypatch.setattr(T, "SIZE", 300)
    rnd = random.Random(4)
    hot = [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Same.", f"text {t}.", f"text {t}", "", "Other!"])) for t in range(400)]
    check(spark, table(60, 2) + hot + [(8, 5, "user", "same row.")] * 60 + [(9, None, "user", f"{i}") for i in range(40)])


def test_all_dropped_and_empty(spark):
    dropped = [(c, 0, "user", "x") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    check(spark, dropped)
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.repair(T.damage(df)).collect() == []


def test_powers_equal_repeated_products():
    p = T.Powers()
    for s in T.SYMBOLS:
        v = np.array(T.END)
        for n in range(1, 40):
            v = T.times(T.matrix(s), v)
            assert (p.advance(s, n, np.array(T.END)) == v).all()


def test_tally_of_parts():
    rnd = random.Random(8)
    rows = [
        (t, rnd.choice(["s", "u", "a"]), "x") for t in [None, None, 1, 1, 2, 5, 5, 9]]
    whole = T.coded(rows, [True] * len(rows))[1]
    for cut in range(len(rows) + 1):
        a, b = T.coded(rows[:cut], [True] * cut)[1], T.coded(rows[cut:], [True] * (len(rows) - cut))[1]
        a.add(b)
        assert a.pack() == whole.pack() and a.gaps == whole.gaps
