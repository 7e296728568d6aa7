"""Licence scan with ordered signature rules, in DataFrame functions only.

A text becomes its lower-case words with one blank between them (words are
runs of ASCII letters, digits and all other characters beyond ASCII).  Hundreds
of hand-written regexes (``licenserules``) look for licence identifiers,
sentences, names and hints in it.  Two keyword filters come first: a text
without a gate word is done; in the others only rules whose keyword and regex
match near a gate word search the text.  Their places become word intervals.

Overlaps are resolved in one sweep over the intervals by start: a detection
goes if its interval lies inside that of one with a higher priority, or with
the same priority that starts earlier, ends later or, at the same interval,
has an earlier rule.  What is left gives the labels.

Everything happens inside the row: no shuffle, no group, and a frequent
licence costs no more than the regexes of its texts.

Defined results: a null text counts as empty; a text without words or without
detections has no labels, score 0; the Kelvin sign counts as a character
beyond ASCII (not as ``k``); the score is the certainty of the best remaining
detection (1, 0.8 or 0.5 by priority); repeated rows are scanned each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.llm.base import table
from quire.llm.licenserules import GATE, REACH, rules

BASE = ["mit", "apache", "gpl"]               # labels of the first three rules, whose places are all counted
CERTAINTY = [0.0, 0.5, 0.8, 1.0]              # by priority


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normal(text: Column) -> Column:
    """' word word ... word ' (one blank for a text without words)."""
    # the one capital letter beyond ASCII whose small letter is plain ASCII and nothing else
    t = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ſ")))
    return F.regexp_replace(F.concat(F.lit(" "), t, F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def blanks(x: Column) -> Column:
    return F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit("")))


def before(x: Column) -> Column:
    """Exclusive prefix sums of an int array in O(n ** (4/3)): chunks of about
    n ** (1/3), their totals, then the sums inside each chunk."""
    zero = F.lit(0)

    def total(a):
        return F.aggregate(a, zero, lambda s, v: s + v)

    def chunked(a, size):
        chunks = F.transform(F.sequence(zero, F.floor((F.size(a) - 1) / size).cast("int")),
                             lambda j: F.slice(a, j * size + 1, size))
        return _let(chunks, lambda ch: _let(F.transform(ch, total), lambda tot: F.flatten(F.transform(
            ch, lambda c, j: _let(total(F.slice(tot, F.lit(1), j)), lambda base: F.transform(
                c, lambda v, i: base + total(F.slice(c, F.lit(1), i))))))))

    return F.when(F.size(x) > 0, _let(F.ceil(F.cbrt(F.size(x).cast("double"))).cast("int"), lambda size: chunked(x, size))) \
            .otherwise(F.array().cast("array<int>"))


def whole(regex: Column) -> Column:
    """The regex on whole words."""
    return F.concat(F.lit(" (?:"), regex, F.lit(")(?= )"))


def places(norm: Column, regex: Column) -> Column:
    """Array of (start, words) of the regex's matches, in words."""
    def build(found):
        lens = F.transform(found, blanks)
        gaps = F.transform(F.slice(F.split(norm, whole(regex), -1), F.lit(1), F.size(found)), blanks)
        return _let(lens, lambda n: _let(gaps, lambda g: F.zip_with(
            F.zip_with(before(F.zip_with(g, n, lambda a, b: a + b)), g, lambda a, b: a + b), n,
            lambda s, w: F.struct(s.alias("start"), w.alias("words")))))

    return _let(F.regexp_extract_all(norm, whole(regex), F.lit(0)), build)


def _table(names=None) -> Column:
    rows = [F.struct(F.lit(o).alias("rule"), F.lit(l).alias("label"), F.lit(p).alias("priority"), F.lit(k).alias("keyword"),
                     F.lit(r).alias("regex")) for o, l, p, k, r in (names or rules())]
    return F.array(*rows)


DETECTION = "array<struct<start:int,end:int,back:int,first:int,rule:int,label:string,priority:int>>"


def surroundings(norm: Column) -> Column:
    """The gate words with ``REACH`` characters on either side; what lies
    between is a line break, which no rule matches.  Every match of a rule
    holds a gate word, so it is in here as a whole."""
    def short(segment):
        return F.when(F.length(segment) > 2 * REACH, F.concat(F.left(segment, F.lit(REACH)), F.lit("\n"), F.right(segment, F.lit(REACH)))) \
                .otherwise(segment)

    gates = F.concat(F.regexp_extract_all(norm, F.lit(GATE), F.lit(0)), F.array(F.lit("")))
    return F.array_join(F.zip_with(F.split(norm, GATE, -1), gates, lambda s, g: F.concat(short(s), g)), "")


def detections(norm: Column) -> Column:
    """All detections as (start, end, -end, -priority, rule, label, priority)."""
    def of(found, rule):
        return F.transform(found, lambda p: F.struct(
            p["start"].alias("start"), (p["start"] + p["words"]).alias("end"), (-p["start"] - p["words"]).alias("back"),
            (-rule["priority"]).alias("first"), rule["rule"].alias("rule"), rule["label"].alias("label"),
            rule["priority"].alias("priority")))

    def likely(near):
        return F.filter(_table(), lambda r: F.contains(near, r["keyword"]) & F.regexp_like(near, whole(r["regex"])))

    hits = F.flatten(F.transform(_let(surroundings(norm), likely), lambda r: of(places(norm, r["regex"]), r)))
    return F.when(F.regexp_like(norm, F.lit(GATE)), hits.cast(DETECTION)).otherwise(F.array().cast(DETECTION))


def resolve(found: Column) -> Column:
    """The detections that survive priority and containment: a struct of
    ``labels`` (distinct), ``kept`` (how many) and ``best`` (priority)."""
    order = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), d["back"].alias("back"), d["first"].alias("first"), d["rule"].alias("rule"),
        d["end"].alias("end"), d["label"].alias("label"), d["priority"].alias("priority"))))
    zero = F.struct(F.lit(0).alias("e1"), F.lit(0).alias("e2"), F.lit(0).alias("e3"),
                    F.array().cast("array<string>").alias("labels"), F.lit(0).alias("kept"), F.lit(0).alias("best"))
    kind = "struct<e1:int,e2:int,e3:int,labels:array<string>,kept:int,best:int>"

    def step(acc, d):
        p, end = d["priority"], d["end"]
        # farthest end so far among detections of at least this priority
        reach = F.when(p == 3, acc["e3"]).when(p == 2, F.greatest(acc["e2"], acc["e3"])).otherwise(
            F.greatest(acc["e1"], acc["e2"], acc["e3"]))
        keep = end > reach
        return F.struct(
            F.when(p == 1, F.greatest(acc["e1"], end)).otherwise(acc["e1"]).alias("e1"),
            F.when(p == 2, F.greatest(acc["e2"], end)).otherwise(acc["e2"]).alias("e2"),
            F.when(p == 3, F.greatest(acc["e3"], end)).otherwise(acc["e3"]).alias("e3"),
            F.when(keep & ~F.array_contains(acc["labels"], d["label"]), F.array_append(acc["labels"], d["label"]))
             .otherwise(acc["labels"]).alias("labels"),
            (acc["kept"] + keep.cast("int")).alias("kept"),
            F.when(keep, F.greatest(acc["best"], p)).otherwise(acc["best"]).alias("best")).cast(kind)

    return F.aggregate(order, zero.cast(kind), step)


def scan(docs: DataFrame, text: str = "text", out: str = "licences") -> DataFrame:
    """Adds ``out``: a struct of ``n_words``, ``found`` (all detections),
    ``labels``, ``kept`` and ``best``."""
    x = docs.withColumn("__norm", normal(F.col(text).cast("string")))
    x = x.withColumn("__found", detections(F.col("__norm")))
    n = F.greatest(blanks(F.col("__norm")) - 1, F.lit(0)).cast("bigint")
    x = x.withColumn("__kept", resolve(F.col("__found")))
    return x.withColumn(out, F.struct(n.alias("n_words"), F.col("__found").alias("found"), F.col("__kept.labels").alias("labels"),
                                      F.col("__kept.kept").alias("kept"), F.col("__kept.best").alias("best"))) \
            .drop("__norm", "__found", "__kept")


def op13_license_rules(spark, sf_dir: str) -> DataFrame:
    x = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "licences.*")
    x = x.withColumn("base", F.filter("found", lambda d: d["rule"] < len(BASE)))
    names = F.array_sort(F.array_distinct(F.col("base.label")))
    score = F.element_at(F.array(*[F.lit(c) for c in CERTAINTY]), F.col("best") + 1)
    return x.select("doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
                    F.array_min("base.start").cast("bigint").alias("first_word"),
                    F.array_max("base.start").cast("bigint").alias("last_word"),
                    F.array_join(names, ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_distinct(F.concat(names, "labels"))), ",").alias("labels"), score.alias("score"))
