"""Document filters (C2-C4, D1-D4, D8) and the text stage that feeds dedupe."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from quire.functions.text import JAVA_WS, WS_CLASS, collapse_lines, has_tokens, py_strip, ws_tokens
from quire.operators.order import dense_index
from quire.session import fits, materialize

EDGE_CLASS = "[\\p{P}\\p{S}]"

# The keyword list of the strict configuration, one per line in
# the source file, in file order.
SECURITY_KEYWORDS = [
    "malware", "ransomware", "phishing", "exploit", "vulnerability", "CVE", "zero-day", "botnet",
    "DDoS", "APT", "trojan", "rootkit", "spyware", "adware", "credential", "encryption", "firewall",
    "IDS", "IPS", "SIEM", "SOC", "IOC", "threat", "attack", "payload", "payload-delivery",
    "command-and-control", "privilege-escalation", "incident-response", "digital-forensics",
    "penetration-testing", "ethical-hacking", "data-breach", "data-exfiltration", "sandboxing",
    "sandbox-escape", "lateral-movement", "defense-evasion", "persistence",
]

# Keyword lists up to this length become an array literal; longer ones are
# joined.  Both apply the same rule, so the answer does not depend on it.
LITERAL_KEYWORDS = 500
SUBSTRING_CHUNK = 2_000        # keywords per regex in substring mode


def split_documents(df: DataFrame, text: str = "text", marker: str = "ENDDOC", key: str = "doc_id",
                    out_key: str = "doc_id") -> DataFrame:
    """Split each text at ``marker`` into several documents (stripped,
    blanks dropped), numbered densely in (key, piece) order as ``out_key``."""
    parts = df.select(F.col(key).alias("_k"), F.posexplode(F.split(text, re.escape(marker))).alias("_i", "_t"))
    parts = parts.select("_k", "_i", py_strip("_t").alias(text)).where(F.col(text) != "")
    return dense_index(materialize(parts), ["_k", "_i"], out=out_key).select(out_key, text)


def collapse_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """C4 + D1 + C3: strip, drop blank documents, one line per document."""
    x = df.withColumn(text, py_strip(text)).where(F.col(text) != "")
    return x.withColumn(text, collapse_lines(text))


def filter_min_len(df: DataFrame, min_len: int, text: str = "text") -> DataFrame:
    """Keep documents with at least ``min_len`` whitespace tokens."""
    if min_len <= 0:
        return df
    return df.where(has_tokens(text, min_len))


def _keyword_regex(words) -> str:
    """Alternation of the literal words, generated as a prefix trie
    (``pay(?:load(?:-delivery)?)``-style) so the regex engine follows one
    branch per character instead of trying every word at every position."""
    trie: dict = {}
    for w in sorted(set(words)):
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node) -> str:
        end = "" in node
        kids = [(c, n) for c, n in sorted(node.items()) if c != ""]
        alts = []
        for c, n in kids:
            # follow single-child chains as one literal run
            run = re.escape(c)
            while len(n) == 1 and "" not in n:
                (c2, n2), = n.items()
                run += re.escape(c2)
                n = n2
            alts.append(run + emit(n) if n else run)
        if not alts:
            return ""
        body = alts[0] if len(alts) == 1 else "(?:" + "|".join(alts) + ")"
        return "(?:" + body + ")?" if end else body

    return emit(trie)


def keyword_tokens(col):
    """The units keywords are compared with: whitespace tokens of the
    lower-cased text without leading and trailing punctuation and symbols
    (``anti-malware-suite`` is one unit).  Look-behinds keep every rewrite
    linear in long runs of punctuation."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    c = F.regexp_replace(c, "(?<!" + EDGE_CLASS + ")" + EDGE_CLASS + "++(?=" + WS_CLASS + "|\\z)", "")
    c = F.regexp_replace(c, "(?<=\\A|" + WS_CLASS + ")" + EDGE_CLASS + "++", "")
    return ws_tokens(c)


def _run_at(units, m: int):
    return lambda i: F.array_join(F.slice(units, i, m), " ")


def keyword_units(col, sizes):
    """Runs of 1, 2, ... neighbouring units, for keywords of several words."""
    t = keyword_tokens(col)
    out = [t if 1 in sizes else F.array().cast("array<string>")]
    for m in sorted(set(sizes) - {1}):
        starts = F.sequence(F.lit(1), F.greatest(F.size(t) - (m - 1), F.lit(1)))
        out.append(F.when(F.size(t) >= m, F.transform(starts, _run_at(t, m))).otherwise(F.array().cast("array<string>")))
    return F.flatten(F.array(*out)) if len(out) > 1 else out[0]


def _unit_match(col, words):
    """Is one of ``words`` a unit of :func:`keyword_tokens`?  A word of such a list
    begins and ends with neither punctuation nor symbol, so it is one exactly
    where it stands between white space and runs of these: one search, and no
    array of the units."""
    edge = EDGE_CLASS + "*+"
    return F.concat(F.lit(" "), F.lower(col), F.lit(" ")).rlike(JAVA_WS + edge + "(?:" + _keyword_regex(words) + ")" + edge + JAVA_WS)


def normal_keywords(keywords: DataFrame) -> DataFrame:
    """``keyword, words``: cleaned like the texts, blanks dropped, distinct."""
    k = keywords.select(keyword_tokens("keyword").alias("_t")).where(F.size("_t") > 0)
    return k.select(F.array_join("_t", " ").alias("keyword"), F.size("_t").alias("words")).distinct()


def filter_keywords(df: DataFrame, keywords, text: str = "text", mode: str = "token",
                    key: str = "doc_id") -> DataFrame:
    """D3: keep documents holding at least one keyword (case-insensitive).

    ``keywords`` is a list or a ``keyword`` DataFrame; blank ones are ignored,
    and ``None`` or a list without any keyword turns the filter off.
    ``mode="token"``: a keyword equals a unit of :func:`keyword_tokens` (or a
    run of units, for keywords of several words).  Short lists are one regex, or
    an array literal if a keyword has several words, long ones a semi join on the
    exploded distinct units.
    ``mode="substring"``: a keyword occurs anywhere, by regex.
    """
    if keywords is None:
        return df
    if not isinstance(keywords, DataFrame):
        keywords = df.sparkSession.createDataFrame([(w,) for w in keywords], "keyword string")
    if mode == "substring":
        return _substring(df, keywords, text)
    kw = materialize(normal_keywords(keywords))
    sizes = [r["words"] for r in kw.select("words").distinct().collect()]      # lengths of keywords
    if not sizes:
        return df
    if fits(kw.select("keyword"), LITERAL_KEYWORDS, 1 << 20):
        words = [r["keyword"] for r in kw.select("keyword").collect()]
        if sizes == [1]:
            return df.where(_unit_match(F.col(text), words))
        return df.where(F.arrays_overlap(keyword_units(text, sizes), F.array(*[F.lit(w) for w in words])))
    units = df.select(key, F.explode(F.array_distinct(keyword_units(text, sizes))).alias("keyword"))
    side = kw.select("keyword")
    hits = units.join(F.broadcast(side) if fits(side, 1_000_000) else side, "keyword", "left_semi").select(key).distinct()
    return df.join(hits, key, "left_semi")


def _substring(df: DataFrame, keywords: DataFrame, text: str) -> DataFrame:
    """One prefix-trie regex per ``SUBSTRING_CHUNK`` keywords; a keyword list
    too large for the query text raises."""
    kw = keywords.select(F.lower("keyword").alias("keyword")).where(py_strip("keyword") != "").distinct()
    if not fits(kw, 200_000, 8 << 20):
        raise ValueError("substring keywords are part of the query text: at most 200,000 (8 MiB)")
    words = sorted(r["keyword"] for r in kw.collect())
    if not words:
        return df
    low = F.lower(F.col(text))
    found = None
    for s in range(0, len(words), SUBSTRING_CHUNK):
        hit = low.rlike("(?:" + _keyword_regex(words[s:s + SUBSTRING_CHUNK]) + ")")
        found = hit if found is None else found | hit
    return df.where(found)


def filter_language(df: DataFrame, lang: str = "en", column: str = "lang", skip: bool = False) -> DataFrame:
    """Keep documents in ``lang``; ``skip`` turns the filter off."""
    if skip:
        return df
    return df.where(F.col(column) == F.lit(lang))


def reject_malformed(df: DataFrame, ok: str = "ok"):
    """Split a tolerant ``.seq`` read into (good, rejected)."""
    return df.where(F.col(ok)).drop(ok, "line"), df.where(~F.col(ok))
