"""Readers and writers, including the golden debug triple."""

import os
import tempfile

from pyspark.sql import functions as F

from quire.functions.text import collapse_lines
from quire.sources import readers as R
from quire.sources import sinks as K

# The golden debug triple (raw dump -> extracted -> filtered).
RAW = ("<html><body><h1>Doc 1</h1><p>Hello, world0!</p></body></html>\n"
       "<html><body><h1>Doc 1a</h1><p>Hello, whappyorld0!</p></body></html>\n"
       "---ENDDOC---\n"
       "<html><body><h1>Doc 2</h1><p>This page mentions an email0: alice@example.com</p></body></html>\n"
       "---ENDDOC---\n"
       "<html><body><h1>Doc 3</h1><p>Foo bar baz. Repeat foo bar0.</p></body></html>\n"
       "---ENDDOC---\n")
EXTRACTED = "Doc 1\nHello, world0!\n---ENDDOC---\n"
FILTERED = ["Doc 1 Hello, world0! ---", "---"]


def _write(text, name="f.txt", mode="w"):
    d = tempfile.mkdtemp(prefix="quire-src-")
    p = os.path.join(d, name)
    with open(p, mode) as f:
        f.write(text)
    return p


def test_golden_filter_half(spark):
    p = _write(EXTRACTED)
    docs = R.read_sentinel_docs(spark, p, marker="ENDDOC")
    out = docs.select("doc_id", collapse_lines("text").alias("t")).orderBy("doc_id").collect()
    assert [r.t for r in out] == FILTERED


def test_debug_input_from_raw_dump_to_ids(spark):
    """The whole small pipeline: dump, extraction, sentinel file, filter, dedupe,
    scrub, split, windows; every stage written out."""
    from quire.functions.pii import scrub
    from quire.operators.dedupe import exact_dedupe
    from quire.plans.prep import PrepConfig, pages_to_documents, tokenize_and_pack
    # a page twice, so that dedupe has something to do
    again = "<html><body><h1>Doc 2</h1><p>This page mentions an email0: alice@example.com</p></body></html>\n---ENDDOC---\n"
    pages = R.read_page_dump(spark, _write(RAW + again)).withColumnRenamed("ord", "page_id")
    docs = pages_to_documents(pages)
    first, second, third = ("Doc 1\nHello, world0!\nDoc 1a\nHello, whappyorld0!",
                            "Doc 2\nThis page mentions an email0: alice@example.com", "Doc 3\nFoo bar baz. Repeat foo bar0.")
    assert [r.text for r in docs.orderBy("doc_id").collect()] == [first, second, third, second]
    d = tempfile.mkdtemp(prefix="quire-debug-")
    K.write_text(docs.select("doc_id", K.sentinel_value().alias("value")), d + "/x", order="doc_id")
    back = R.read_sentinel_docs(spark, d + "/x")
    lines = back.select("doc_id", collapse_lines("text").alias("text"))
    clean = exact_dedupe(lines).select("doc_id", scrub("text").alias("text"))
    got = [r.text for r in clean.orderBy("doc_id").collect()]
    assert got[0] == "Doc 1 Hello, world0! Doc 1a Hello, whappyorld0!" and got[2] == "Doc 3 Foo bar baz. Repeat foo bar0."
    assert len(got) == 3 and "alice" not in got[1] and got[1].startswith("Doc 2 This page mentions an email0: ")
    vocab, packed = tokenize_and_pack(clean, PrepConfig(seq_len=4))
    word = {r.id: r.token for r in vocab.collect()}
    text = {s: " ".join(word[i] for r in packed.where(F.col("split") == s).orderBy("seq_id").collect() for i in r.input_ids)
            for s in ("train", "test")}
    # two of three documents train; 8 + 8 and 8 words in windows of 4
    n = len((got[0] + " " + got[1]).split()) // 4 * 4
    assert text["train"].split() == (got[0] + " " + got[1]).split()[:n]
    assert text["test"].split() == got[2].split()[:len(got[2].split()) // 4 * 4]


def test_end_report_lines(spark):
    from quire.operators.report import end_report
    df = spark.createDataFrame([("train", 0, [1, 22]), ("train", 0, [3]), ("test", 2, [444, 5]), ("train", 2, [])],
                               "split string, shard int, input_ids array<int>")
    d = tempfile.mkdtemp(prefix="quire-report-")
    K.write_text(end_report(df, 3), d + "/r", order="ord")
    assert [r.value for r in R.read_text_ordered(spark, d + "/r").orderBy("ord").collect()] == [
        " type  | shard | lines | bytes",
        " train |     0 |     2 |     7", "  test |     0 |     0 |     0",
        " train |     1 |     0 |     0", "  test |     1 |     0 |     0",
        " train |     2 |     1 |     1", "  test |     2 |     1 |     6",
        " Thread 0: 3 tokens", " Thread 1: 0 tokens", " Thread 2: 0 tokens", " Total tokens across all threads: 3"]


def test_page_dump_url_framing_is_one_page(spark):
    p = _write(RAW)
    pages = R.read_page_dump(spark, p, framing="url").collect()
    assert len(pages) == 1 and pages[0].html == RAW


def test_page_dump_sentinel_roundtrip(spark):
    df = spark.createDataFrame([(0, "http://a/x", "<p>one</p>"), (1, "http://a/y", "<p>two\nlines</p>")],
                               "page_id long, url string, html string")
    d = tempfile.mkdtemp(prefix="quire-dump-")
    K.write_text(df.select("page_id", K.page_dump_value().alias("value")), d + "/dump", order="page_id")
    back = R.read_page_dump(spark, d + "/dump").orderBy("ord").collect()
    assert [(r.url, r.html) for r in back] == [("http://a/x", "<p>one</p>"), ("http://a/y", "<p>two\nlines</p>")]


def test_ordered_lines_across_files(spark):
    d = tempfile.mkdtemp(prefix="quire-multi-")
    for name, lines in (("train_thread10.seq", ["7 8"]), ("train_thread2.seq", ["1 2", "", "3 x"]),
                        ("train_thread1.seq", ["4 5 6"])):
        with open(os.path.join(d, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    got = R.read_sequences(spark, d + "/train_thread*.seq", tolerant=True).orderBy("seq_id").collect()
    # lexicographic path order: thread1, thread10, thread2
    assert [r.line for r in got] == ["4 5 6", "7 8", "1 2", "3 x"]
    assert [r.ok for r in got] == [True, True, True, False]


def test_sft_pretty_records_and_specials(spark):
    # own records in the format's three-line framing
    rec = ('{"input": "Name a warm colour.", \n "trace": "Think of a sunset.\\nPick one.", \n "answer": "orange"}\n'
           '{"input": "Reverse the word star", \n "trace": "Letter by letter.", \n "answer": "rats"}\n')
    got = R.read_sft_records(spark, _write(rec)).orderBy("ord").collect()
    assert [(r.input, r.trace, r.answer) for r in got] == [("Name a warm colour.", "Think of a sunset.\nPick one.", "orange"),
                                                           ("Reverse the word star", "Letter by letter.", "rats")]
    sp = ('{"bos_token": {"content": "<|b|>", "lstrip": false, "normalized": false, "rstrip": false, '
          '"single_word": false}, "eos_token": {"content": "<|e|>", "lstrip": false, "normalized": false, '
          '"rstrip": false, "single_word": false}}')
    s = {r.name: r.content for r in R.read_special_tokens(spark, _write(sp, "m.json")).collect()}
    assert s == {"bos_token": "<|b|>", "eos_token": "<|e|>"}


def test_keyword_and_line_lists(spark):
    kw = R.read_keywords(spark, _write("malware\n  CVE \n\nzero-day, botnet\n"))
    assert sorted(r.keyword for r in kw.collect()) == ["CVE", "botnet", "malware", "zero-day"]
    seeds = R.read_line_list(spark, _write("  https://a.example/ \n\nhttps://b.example\n"))
    assert [r.url for r in seeds.orderBy("ord").collect()] == ["https://a.example/", "https://b.example"]


def test_page_dump_edge_cases(spark):
    # empty page, a body line that looks like a header, no line break after the last marker
    raw = ("URL: http://a/1\n<html>\n\n</html>\n---ENDDOC---\nURL: http://a/2\n<html>\nx\nURL: not a header\n</html>\n---ENDDOC---\n"
           "URL: http://a/3\n<html>\nlast\n</html>\n---ENDDOC---")
    got = R.read_page_dump(spark, _write(raw)).orderBy("ord").collect()
    assert [(r.url, r.html) for r in got] == [("http://a/2", "x\nURL: not a header"), ("http://a/3", "last")]


def test_bad_bytes_go_and_replacement_characters_stay(spark):
    data = (b"a\xffb---ENDDOC---c " + "\ufffd".encode() + b" d---ENDDOC---e" + "\ufffd".encode() + b"\xc3(f---ENDDOC---")
    got = R.read_sentinel_docs(spark, _write(data, mode="wb")).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["ab", "c \ufffd d", "e\ufffd(f"]


def test_line_docs_sequences_and_shard_files(spark):
    p = _write("one \n\n  two\n")
    assert [r.text for r in R.read_line_docs(spark, p).orderBy("doc_id").collect()] == ["one", "two"]
    assert [r.text for r in R.read_line_docs(spark, p, drop_blank=False).orderBy("doc_id").collect()] == ["one ", "", "  two"]
    d = tempfile.mkdtemp(prefix="quire-shards-")
    df = spark.createDataFrame([(i, i % 2, f"{i} {i + 1}") for i in range(6)], "k int, shard int, value string")
    paths = K.write_shards(df, d, "train_thread", order="k")
    assert [os.path.basename(x) for x in paths] == ["train_thread0.seq", "train_thread1.seq"]
    assert open(os.path.join(d, "train_thread1.seq")).read() == "1 2\n3 4\n5 6\n"
    got = R.read_sequences(spark, d + "/train_thread*.seq").orderBy("seq_id").collect()
    assert [list(r.input_ids) for r in got] == [[0, 1], [2, 3], [4, 5], [1, 2], [3, 4], [5, 6]]


def test_numbered_shard_files(spark):
    """Files cut at lengths, ties and a null key kept, one shard read alone, a
    second run taking over, a lost file raising."""
    import pytest
    d = tempfile.mkdtemp(prefix="quire-files-")
    rows = [(i, 10 * (i % 2), f"{i} {i * i}") for i in range(60)] + [(None, 10, "7"), (59, 10, "8"), (5, 0, "9 " * 300), (-1, 0, "1 " * 50), (-1, 0, "1 " * 50)]
    df = spark.createDataFrame(rows, "k long, shard int, value string")
    n = K.write_shard_files(df, d, "ids", order="k", max_bytes=40)
    assert 10 <= n <= 30
    m = spark.read.json(d + "/ids.manifest").orderBy("ord").collect()
    assert [r.ord for r in m] == list(range(n)) and {r.shard for r in m} == {"0", "10"}
    assert [r.number for r in m if r.shard == "10"] == list(range(sum(r.shard == "10" for r in m)))
    got = [list(r.input_ids) for r in R.read_sequence_shards(spark, d, "ids").orderBy("seq_id").collect()]
    want = [[int(t) for t in v.split()] for _, _, v in sorted(rows, key=lambda r: (r[1], -1 if r[0] is None else r[0]))]
    assert sorted(got) == sorted(want) and [g[:1] for g in got if g not in ([9] * 300, [8])] == [
        w[:1] for w in want if w not in ([9] * 300, [8])]
    ten = R.read_sequence_shards(spark, d, "ids", shard=10).orderBy("seq_id").collect()
    assert [list(r.input_ids) for r in ten] == got[-len(ten):] and len(ten) == 32
    assert K.write_shard_files(df.where("k < 2"), d, "ids", order="k") >= 2
    back = R.read_sequence_shards(spark, d, "ids").orderBy("seq_id").collect()
    assert [list(r.input_ids) for r in back] == [[1] * 50, [1] * 50, [0, 0], [1, 1]]
    assert K.write_shard_files(df.where("k < -5"), d, "none", order="k") == 0
    assert R.read_sequence_shards(spark, d, "none").collect() == []
    with pytest.raises(ValueError):
        K.write_shard_files(df.withColumn("shard", F.lit(None).cast("int")), d, "bad", order="k")
    os.remove(R.manifest_files(spark, d, "ids")[0].replace("file:", ""))
    with pytest.raises(Exception):
        R.read_sequence_shards(spark, d, "ids").collect()


def test_strict_sequences_raise(spark):
    import pytest
    with pytest.raises(Exception):
        R.read_sequences(spark, _write("1 2\n3 x\n")).collect()


def test_partitioned_text(spark):
    d = tempfile.mkdtemp(prefix="quire-part-")
    df = spark.createDataFrame([(0, "train", "a"), (1, "test", "b"), (2, "train", "c")], "o int, split string, value string")
    K.write_text(df, d + "/x", order="o", partition_by=["split"])
    back = spark.read.text(d + "/x")
    assert sorted((r.split, r.value) for r in back.collect()) == [("test", "b"), ("train", "a"), ("train", "c")]


def test_page_dump_keeps_pages_with_nulls(spark):
    from quire.sources.sinks import page_dump_value
    df = spark.createDataFrame([("u", None), (None, "<p>x"), (None, None)], "url string, html string")
    got = sorted(r.v for r in df.select(page_dump_value().alias("v")).collect())
    end = "\n</html>\n---ENDDOC---"
    assert got == sorted(["URL: u\n<html>\n" + end, "URL: \n<html>\n<p>x" + end, "URL: \n<html>\n" + end])


def test_tolerant_reader_casts_only_tokens_with_a_digit(spark, tmp_path):
    from quire.functions.text import text_to_ids
    from quire.sources.readers import read_sequences
    (tmp_path / "a.seq").write_text("1 2 3\n\nx y\n 4 5x\n　\n-7 +8\n")
    got = sorted((r.seq_id, r.ok, list(r.input_ids)) for r in read_sequences(spark, str(tmp_path / "a.seq"), tolerant=True).collect())
    assert got == [(0, True, [1, 2, 3]), (2, False, [None, None]), (3, False, [4, None]), (5, True, [-7, 8])]
    assert "RLIKE" in str(text_to_ids("value", strict=False)).upper()
