"""The corpus pipeline, stage by stage."""

import os
import random
from hashlib import sha256

import pytest
import tiktoken

import corpus_pipeline as P
from quire.llm import bytebpe

SF = "/root/testdata/sf0.01"


def test_stages_are_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "byte_bpe"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables with planted rows of every kind."""
    rnd = random.Random(12)
    langs = {"en": "the and of to with from that which was are".split(), "de": "der und die das mit von nicht auch ist ein".split()}
    rows, labels, bench = [], [], []

    def text(lang, n):
        return " ".join(rnd.choice(langs[lang]) + rnd.choice(["", rnd.choice("abcdefgh") * 2]) for _ in range(n))
    for i in range(8):
        bench.append((i, text("en", 30)))
    for i in range(400):
        lang = "en" if i % 2 else "de"
        t, tox = text(lang, rnd.randrange(40, 90)), i % 10 == 0
        if tox:
            w = t.split()
            for _ in range(4):
                w.insert(rnd.randrange(len(w)), rnd.choice(["zorkface", "vuxhead", "grublick"]))
            t = " ".join(w)
        rows.append((i, t, lang, "s", len(t)))
        labels.append((i, 1, int(tox)))
    rows += [(1000, rows[11][1], "en", "s", 1), (1001, rows[11][1].upper(), "en", "s", 1),         # copies of 11
             (1002, text("en", 20) + " " + bench[3][1] + " " + text("en", 20), "en", "s", 1),       # holds item 3
             (1003, None, "en", "s", 1), (1004, "", None, None, None), (1005, "1234 !!", "en", "s", 1),
             (13, rows[13][1], "en", "s", 1),                                                      # a repeated row
             (None, rows[15][1], "en", "s", 1), (None, text("de", 50), "de", "s", 1)]
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id string") \
         .repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows


def test_planted_rows(spark, tables):
    d, rows = tables
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in P.STAGES:
        out = P.stash(stage(spark, docs, d), "test")
        if name != "byte_bpe":
            assert out.columns == docs.columns
        seen.append(out.collect())
        docs = out
    ids = [sorted(str(r.doc_id) for r in x) for x in seen]
    assert not any(i in ids[0] for i in map(str, range(0, 400, 10)))                    # toxic rows go, the rest stays
    assert len(ids[0]) == len(rows) - 40
    assert set(ids[0]) - set(ids[1]) == {"1003", "1004", "1005"} and len(ids[0]) - len(ids[1]) == 3
    assert sorted(set(ids[1]) - set(ids[2])) == ["1000", "1001"]
    assert len(ids[1]) - len(ids[2]) == 4 and ids[2].count("13") == 1 and ids[2].count("None") == 1
    assert set(ids[2]) - set(ids[3]) == {"1002"}
    codec = tiktoken.Encoding("own", pat_str=__import__("public_tokenizers").PATTERN, special_tokens={},
                              mergeable_ranks=bytebpe.load_ranks(__import__("public_tokenizers").path("byte_bpe_50k.tiktoken")))
    texts = {(str(r.doc_id), sha256(r.text.encode()).hexdigest()): len(codec.encode_ordinary(r.text)) for r in seen[3]}
    assert {(str(r.doc_id), r.decoded_sha256): r.n_tokens for r in seen[4]} == texts


def test_unlearned_languages_are_rejected(spark):
    rnd = random.Random(8)
    words = {"en": "the and of to with from that which was are".split(), "de": "der und die das mit von nicht auch ist ein".split()}
    rows = [(i, " ".join(rnd.choices(words[lang], k=rnd.choice([1, 5, 60]))), lang) for i in range(200) for lang in words]
    for a, b in ((0x430, 0x44f), (0x3b1, 0x3c9), (0x3041, 0x3096), (0x4e00, 0x9000)):        # Cyrillic, Greek, Kana, Han
        rows += [(-1, " ".join("".join(chr(rnd.randint(a, b)) for _ in range(rnd.randint(2, 9))) for _ in range(120)), None)
                 for _ in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = P.drop_unknown_language(spark, docs, "").collect()
    assert sorted(r.text for r in got) == sorted(t for _, t, lang in rows if lang)


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    rnd = random.Random(3)
    a, b, c, *many = [" ".join(str(rnd.randrange(10 ** 6)) for _ in range(60)) for _ in range(203)]
    rows = [(5, a, "en"), (5, a, "en"), (5, b, "en"), (2, b.upper() + " ", "en"), (5, c, None), (5, c, "en"),
            (9, None, c), (9, c, None), *[(7, t, "en") for t in many]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = [(r.doc_id, r.text) for r in P.drop_near_duplicates(spark, P.stash(docs, "test"), "").collect()]
    groups = [(5, a), (2, b.upper() + " "), (9, None), *[(7, t) for t in many]]
    assert sorted(got, key=str) == sorted([*groups, (5, c)], key=str)


def test_empty_documents(spark, tables, tmp_path):
    d, _ = tables
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{d}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_keeps_clean_documents(spark):
    got = P.run(spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.6 * n < got.count() < n
