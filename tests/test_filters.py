"""Keyword filter: literal and joined keywords give the same documents."""

import pytest

from quire.operators import filters as FL

DOCS = ["Ransomware hit the firm", "a zero-day (CVE) was used", "Tokens: botnet, DDoS.", "nothing here",
        "malwares everywhere", "pre-exploit phase", "word spyware", "\U0001f600\U0001f600 malware", "anti-malware-suite",
        "!!!malware???", "lateral   movement\nfound", "", "..."]
WORDS = ["Malware", "ransomware", "CVE", "zero-day", "botnet", "ddos", "exploit", "spyware", "lateral movement", "", "  "]
TOKEN = [0, 1, 2, 6, 7, 9, 10]
SUBSTRING = [0, 1, 2, 4, 5, 6, 7, 8, 9]
NEVER = [f"neverseen{i}" for i in range(600)]


@pytest.mark.parametrize("extra", [[], NEVER])
def test_keywords(spark, extra):
    df = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, text string")
    kw = spark.createDataFrame([(w,) for w in WORDS + extra], "keyword string")
    for words in (WORDS + extra, kw):
        assert sorted(r.doc_id for r in FL.filter_keywords(df, words).collect()) == TOKEN
        assert sorted(r.doc_id for r in FL.filter_keywords(df, words, mode="substring").collect()) == SUBSTRING


@pytest.mark.parametrize("words", [None, [], ["", " "]])
def test_no_keyword_turns_the_filter_off(spark, words):
    df = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, text string")
    for mode in ("token", "substring"):
        assert FL.filter_keywords(df, words, mode=mode).count() == len(DOCS)


def test_split_documents_numbers_pieces_densely(spark):
    df = spark.createDataFrame([(10**15, "a ENDDOC  ENDDOC b"), (3, "c")], "doc_id long, text string")
    assert [(r.doc_id, r.text) for r in FL.split_documents(df).orderBy("doc_id").collect()] == [(0, "c"), (1, "a"), (2, "b")]


def test_reject_malformed(spark):
    df = spark.createDataFrame([(1, True, "x"), (2, False, "y")], "k int, ok boolean, line string")
    good, bad = FL.reject_malformed(df)
    assert [r.k for r in good.collect()] == [1] and [r.line for r in bad.collect()] == ["y"]


def test_units_by_regex_equal_units_by_array(spark):
    """Every run of two pieces around a keyword, by both forms of the rule."""
    from pyspark.sql import functions as F
    edges = ["", " ", "-", "...", "　", "\x85", "\n", "(«", "x", "€ ", "7", "- -", "\U0001f600"]
    texts = [a + w + b for a in edges for b in edges for w in ("payload", "Payload-Delivery", "ids")] + [None, "", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = ["payload", "payload-delivery", "(ids)"]
    got = {r.doc_id for r in FL.filter_keywords(df, words).collect()}
    units = F.arrays_overlap(FL.keyword_units("text", [1]), F.array(*[F.lit(w) for w in ("payload", "payload-delivery", "ids")]))
    assert got == {r.doc_id for r in df.where(units).collect()} and 0 < len(got) < len(texts)


def test_strict_filters_run_once(spark):
    """The steps after the filters read their result, not the filters again."""
    from quire.plans.prep import STRICT, clean_documents
    df = spark.createDataFrame([(i, "malware " * 120 + f"t{i % 3}") for i in range(6)], "doc_id long, text string")
    st = clean_documents(df, STRICT)
    assert [r.doc_id for r in st["deduped"].orderBy("doc_id").collect()] == [0, 1, 2]
    assert "\\p{P}" not in st["scrubbed"]._jdf.queryExecution().optimizedPlan().toString()
