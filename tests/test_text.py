"""Python string semantics (strip / split / splitlines) on Spark."""

from pyspark.sql import functions as F

from quire.functions.text import LINE_BREAKS, PY_WHITESPACE, collapse_lines, py_strip, split_lines, token_count

SAMPLES = [
    "",
    " ",
    "a",
    "​ a ​",                      # zero-width space is not whitespace
    "  lead and trail \n",
    "x\r\ny\rz\n\nw",
    "tail break\n",
    "two tail\n\n",
    "crlf\r\n",
    "\ttab\x0bvt\x0cff\x1cfs\x1dgs\x1ers\x1fus\x85nel\xa0nbsp ls ps　ideo",
] + ["a" + c + "b" + c for c in PY_WHITESPACE] + [c * 3 for c in PY_WHITESPACE]


def test_constants_match_python():
    assert "".join(c for c in map(chr, range(0x110000)) if c.isspace()) == PY_WHITESPACE
    assert "".join(c for c in map(chr, range(0x3100)) if len(("a" + c + "b").splitlines()) == 2) == LINE_BREAKS


def test_strip_collapse_count(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, x string")
    got = {r.i: r for r in df.select("i", py_strip("x").alias("s"), collapse_lines("x").alias("c"),
                                     token_count("x").alias("n"), split_lines("x").alias("l")).collect()}
    for i, s in enumerate(SAMPLES):
        assert got[i].s == s.strip(), repr(s)
        assert got[i].c == " ".join(s.splitlines()), repr(s)
        assert got[i].n == len(s.split()), repr(s)
        assert list(got[i].l) == s.splitlines(), repr(s)
