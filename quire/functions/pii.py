"""PII scrubbing: three regex rules applied in a fixed order.

Python's ``\\w``, ``\\d`` and ``\\b`` are Unicode-aware; Java's are ASCII by
default, so the classes are written out with Unicode properties.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

WORD = "[\\p{L}\\p{N}_]"

# The rules, replacement tokens and their order.
#   IP     \b\d{1,3}(?:-\d{1,3}){2},\b   -> <IP>
#   EMAIL  [\w\.-]+@[\w\.-]+             -> <EMAIL>
#   PHONE  \+?\d[\d \-()]{7,}\d          -> <PHONE>
RULES = {
    "reference": [
        ("ip", "(?<!" + WORD + ")\\p{Nd}{1,3}(?:-\\p{Nd}{1,3}){2},(?=" + WORD + ")", "<IP>"),
        # the look-behind and the possessive run change no match: a run is tried
        # once, from its start, instead of once per character
        ("email", "(?<![\\p{L}\\p{N}_.-])[\\p{L}\\p{N}_.-]++@[\\p{L}\\p{N}_.-]+", "<EMAIL>"),
        ("phone", "\\+?\\p{Nd}[\\p{Nd} ()-]{7,}\\p{Nd}", "<PHONE>"),
    ],
}
# Our stricter variant also catches dotted IPv4 addresses, before the others.
RULES["strict"] = [
    ("ipv4", "(?<![\\p{N}.])(?:\\p{Nd}{1,3}\\.){3}\\p{Nd}{1,3}(?![\\p{N}])", "<IP>"),
] + RULES["reference"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scrub_rule(col, name: str, rules: str = "reference") -> Column:
    for n, pat, rep in RULES[rules]:
        if n == name:
            return F.regexp_replace(_c(col), pat, rep)
    raise KeyError(name)


def scrub(col, rules: str = "reference") -> Column:
    """Apply the rules in order, each on the output of the previous one."""
    return reduce(lambda acc, r: F.regexp_replace(acc, r[1], r[2]), RULES[rules], _c(col))
