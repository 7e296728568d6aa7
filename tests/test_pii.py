"""Scrub rules line by line, with the expected text written out."""

import random
import re
import time

from pyspark.sql import functions as F

from quire.functions.pii import scrub, scrub_rule

EXPECTED = {
    "12-34-56,x and 1-2-3,4-5-6,y": "<IP>x and <IP><IP>y",
    "host 10.0.0.1 is fine": "host 10.0.0.1 is fine",
    "mail a.b@c.de. now": "mail <EMAIL> now",
    "accented josé.núñez@correo.es here": "accented <EMAIL> here",
    "call +1 (743) 555-3824 today": "call <PHONE> today",
    "runs 12345678 and 123456789 and 1234567890123456": "runs 12345678 and <PHONE> and <PHONE>",
    "no pii at all": "no pii at all",
    "١٢٣٤٥٦٧٨٩ arabic digits": "<PHONE> arabic digits",
    "x_y-z@host_name.example, 7-7-7,": "<EMAIL>, 7-7-7,",
    "two a@b@c and @none and end@": "two <EMAIL>@c and @none and end@",
}


def test_scrub(spark):
    df = spark.createDataFrame([(s,) for s in EXPECTED], "t string")
    assert {r.t: r.s for r in df.select("t", scrub("t").alias("s")).collect()} == EXPECTED


def test_scrub_twice_changes_nothing_more(spark):
    df = spark.createDataFrame([(s,) for s in EXPECTED.values()], "t string")
    assert all(r.t == r.s for r in df.select("t", scrub("t").alias("s")).collect())


def test_email_rule_equals_the_plain_pattern_on_random_strings(spark):
    rnd = random.Random(0)
    lines = ["".join(rnd.choice("ab1._-@@ é,") for _ in range(rnd.randrange(30))) for _ in range(3000)]
    df = spark.createDataFrame([(s,) for s in lines], "t string")
    for r in df.select("t", scrub_rule("t", "email").alias("s")).collect():
        assert r.s == re.sub(r"[\w.-]+@[\w.-]+", "<EMAIL>", r.t), r.t


def test_long_runs_are_linear(spark):
    df = spark.range(1).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))
    began = time.time()
    assert df.select(F.length(scrub("t")).alias("n")).first().n == 1_000_000
    assert time.time() - began < 20
