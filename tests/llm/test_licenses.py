"""Licence scan against a plain version over word lists."""

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quire.llm import licenses as L
from quire.llm.licenserules import GATE, REACH, rules

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def plain(text):
    """(n_words, n_base, first, last, base labels, labels, score)."""
    w = WORDS.findall((text or "").translate(LOWER))
    base = [(i, l) for p, l in PHRASES.items() for i in range(len(w)) if tuple(w[i:i + len(p)]) == p]
    found = []
    norm = " " + "".join(x + " " for x in w)
    for order, label, priority, _, regex in rules():
        for m in re.finditer(" (?:" + regex + ")(?= )", norm):
            start = norm[:m.start()].count(" ")
            found.append((start, start + m.group().count(" "), priority, order, label))
    left = []
    for a in found:
        s, e, p, o, _ = a
        if not any(b is not a and b[0] <= s and e <= b[1] and (
                b[2] > p or b[2] == p and (b[0] < s or e < b[1] or b[3] < o)) for b in found):
            left.append(a)
    names = sorted({l for _, l in base})
    at = [i for i, _ in base]
    score = max((L.CERTAINTY[x[2]] for x in left), default=0.0)
    return (len(w), len(base), min(at, default=None), max(at, default=None), ",".join(names),
            ",".join(sorted(set(names) | {x[4] for x in left})), score)


def run(spark, texts, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("__norm", F.lit("clash")).write.parquet(path)
    rows = L.op13_license_rules(spark, str(tmp_path)).collect()
    return {r.doc_id: tuple(r)[1:] for r in rows}


TEXTS = [
    None, "", "  \n", "no words about it", "MIT License", "the MIT-license, MIT\nLicense and mit  license again",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Released under the MIT license.", "This work is licensed under the GNU General Public License, version 3.",
    "GNU Lesser General Public License v2.1 or the GNU General Public License v2", "Licensed under CC BY-NC 4.0.",
    "SPDX-License-Identifier: GPL-3.0-or-later", "sublicense unlicensed general publıc license", "mitlicense mit license1 1mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "bsd BSD-3-Clause license",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products", "K general public license K", "é mit license ñ apache license 中文 general public license",
    " ".join(["mit license"] * 300), "x " * 5000 + "mit license " + "y " * 5000 + "apache license 2.0 " + "z " * 3000 + "all rights reserved",
    "mit mit license license general public general public license",
]


def test_plain_version(spark, tmp_path):
    got = run(spark, TEXTS + ["mit license"], tmp_path)
    for i, t in enumerate(TEXTS):
        assert got[i] == plain(t), t


def test_mixed_signatures(spark, tmp_path):
    import random
    rnd = random.Random(5)
    parts = [t for t in TEXTS[4:19] if t] + ["gpl v3", "apache 2.0", "filler words", "cc by sa 4 0", "public domain", "as is without warranty of any kind"]
    texts = [" ".join(rnd.choice(parts) for _ in range(rnd.randint(1, 8))) for _ in range(60)]
    got = run(spark, texts, tmp_path)
    for i, t in enumerate(texts):
        assert got[i] == plain(t), t


def test_prefix_sums(spark):
    a = [(i, [(j * 7) % 5 for j in range(n)]) for i, n in enumerate([0, 1, 2, 7, 8, 9, 27, 28, 100, 1000])]
    got = spark.createDataFrame(a, "i int, x array<int>").select("x", L.before(F.col("x")).alias("s")).collect()
    for r in got:
        assert r.s == [sum(r.x[:j]) for j in range(len(r.x))]


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == {}


@pytest.mark.parametrize("part", range(5))
def test_rules_hold_their_keyword_and_a_gate_word(part):
    """On random matches: the keyword is in them, a gate word too, and none is longer than REACH."""
    table = rules()
    assert len(table) >= 200 and [r[0] for r in table] == list(range(len(table)))
    for _, label, priority, keyword, regex in table[part::5]:
        assert priority in (1, 2, 3) and "," not in label
        assert re._parser.parse(regex).getwidth()[1] + 2 <= REACH

        @settings(max_examples=15, deadline=None, database=None, suppress_health_check=list(HealthCheck))
        @given(st.from_regex(re.compile(regex, re.A), fullmatch=True))
        def holds(x):
            x = " " + " ".join(WORDS.findall(x)) + " "
            if re.search(" (?:" + regex + ")(?= )", x):          # a random \\S may be no word character
                assert keyword in x and re.search(GATE, x)
        holds()
