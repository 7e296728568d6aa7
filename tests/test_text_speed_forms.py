"""Whitespace, line breaks and counts against the Python methods they stand for."""

import random

from pyspark.sql import functions as F

from quire.functions import text as T


def test_text_forms_equal_python(spark):
    rnd = random.Random(5)
    signs = list(T.PY_WHITESPACE) + ["\r\n", "a", "é", "‐", "​", "ᚁ", "\x1b", "\U0001f600", "b"]
    texts = ["", " ", "\r\n", "a\r\n", "a\r\r\n", "\n\r", "a ", "　a"]
    texts += ["".join(rnd.choices(signs, k=rnd.randint(0, 9))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(len(texts), None)], "i int, t string")
    got = df.select("i", "t", T.ws_tokens("t").alias("w"), T.token_count("t").alias("n"), T.collapse_lines("t").alias("c"),
                    T.split_lines("t").alias("l"), *[T.has_tokens("t", k).alias(f"h{k}") for k in (1, 2, 3)]).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        if r.t is None:
            assert r.w is None and r.n is None and r.c is None and not r.h1
            continue
        w = r.t.split()
        assert list(r.w) == w and r.n == len(w), repr(r.t)
        assert r.c == " ".join(r.t.splitlines()) and list(r.l) == r.t.splitlines(), repr(r.t)
        assert (r.h1, r.h2, r.h3) == tuple(len(w) >= k for k in (1, 2, 3)), repr(r.t)

