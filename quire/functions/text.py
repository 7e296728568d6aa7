"""Python string semantics re-expressed as Spark column expressions.

The source scripts use ``str.strip``, ``str.split()`` and ``str.splitlines``,
which know more whitespace and more line breaks than Spark's ``trim`` and
``split``.  The sets are spelled out once here and reused by every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The code points for which Python's str.isspace() is true
# (str.strip() and str.split() use exactly these), in code-point order.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The line boundaries of Python's str.splitlines() ("\r\n"
# counts as one boundary), in code-point order.
LINE_BREAKS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"


def char_class(chars: str, negate: bool = False) -> str:
    """A regex character class for a set of code points, consecutive code
    points folded into ranges (Java evaluates fewer alternatives per char).

    Code points are spelled ``\\x{h}``: the same text is valid in Java regex
    (Spark) and RE2 (DuckDB).
    """
    cps = sorted({ord(c) for c in chars})
    runs, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        runs.append("\\x{%x}" % cps[i] if i == j else "\\x{%x}-\\x{%x}" % (cps[i], cps[j]))
        i = j + 1
    return "[" + ("^" if negate else "") + "".join(runs) + "]"


WS_CLASS = char_class(PY_WHITESPACE)
NON_WS_CLASS = char_class(PY_WHITESPACE, negate=True)
BREAK_CLASS = char_class(LINE_BREAKS)
BREAK_RE = "\\r\\n|" + BREAK_CLASS
TRAILING_BREAK_RE = "(?:" + BREAK_RE + ")\\z"


def java_class(chars: str) -> str:
    """The same set for Java alone: code points below 256 one by one, which Java
    looks up in a table, the others behind one range test, so that a letter costs
    two tests instead of one per range."""
    low = "".join("\\x{%x}" % ord(c) for c in chars if ord(c) < 256)
    high = sorted(ord(c) for c in chars if ord(c) > 255)
    some = "".join("\\x{%x}" % c for c in high)
    return "[" + low + ("[\\x{%x}-\\x{%x}&&[%s]]" % (high[0], high[-1], some) if high else "") + "]"


JAVA_WS = java_class(PY_WHITESPACE)
JAVA_BREAK = java_class(LINE_BREAKS)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# A run of white space, but for a lone blank: replaced by a blank, it leaves the
# text that WS_CLASS + "+" does with a match per odd run instead of one per word.
JAVA_ODD_WS = JAVA_WS + "(?:(?<! )|" + JAVA_WS + ")" + JAVA_WS + "*+"


def once(col, f) -> Column:
    """``f(col)`` with ``col`` computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(_c(col)), f), F.lit(0))


def py_strip(col) -> Column:
    """``str.strip()``: drop Python whitespace at both ends."""
    return F.trim(_c(col), F.lit(PY_WHITESPACE))


def is_blank(col) -> Column:
    return py_strip(col) == F.lit("")


def collapse_lines(col) -> Column:
    """``" ".join(s.splitlines())``: every line boundary becomes one space,
    a single trailing boundary disappears, inner spaces stay as they are."""
    return F.regexp_replace(F.replace(_drop_last_break(col), F.lit("\r\n"), F.lit("\n")), JAVA_BREAK, " ")


def _drop_last_break(col) -> Column:
    """Without the line boundary at the end, if any: only the end is looked at."""
    c = _c(col)
    n = F.length(c) - F.when(F.endswith(c, F.lit("\r\n")), 2).when(F.right(c, F.lit(1)).isin(*LINE_BREAKS), 1).otherwise(0)
    return F.substring(c, F.lit(1), n)


def split_lines(col) -> Column:
    """``s.splitlines()`` as an array (empty text gives an empty array)."""
    parts = F.split(F.replace(_drop_last_break(col), F.lit("\r\n"), F.lit("\n")), JAVA_BREAK)
    return F.when(_c(col) == F.lit(""), F.array().cast("array<string>")).otherwise(parts)


def ws_tokens(col) -> Column:
    """``s.split()``: tokens between runs of Python whitespace, no empties."""
    t = py_strip(col)
    return F.when(t == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(t, JAVA_WS + "+"))


def token_count(col) -> Column:
    """``len(s.split())``: strip, then count the pieces between whitespace
    runs (a positive class; a negated one is several times slower in Java)."""
    t = py_strip(col)
    return F.when(t == F.lit(""), F.lit(0)).otherwise(F.size(F.split(t, JAVA_WS + "+"))).cast("bigint")


def has_tokens(col, least: int) -> Column:
    """``len(s.split()) >= least`` for ``least`` > 0: the text is cut ``least - 1``
    times at most, so only its beginning is searched."""
    t = py_strip(col)
    return (t != F.lit("")) & (F.size(F.split(t, JAVA_WS + "+", least)) >= F.lit(least))


def content_hash(col) -> Column:
    """SHA-256 hex of the UTF-8 bytes."""
    return F.sha2(_c(col), 256)


def ids_to_text(col) -> Column:
    """Token ids joined by one space (the ``.seq`` line format)."""
    return F.array_join(F.transform(_c(col), lambda x: x.cast("string")), " ")


def text_to_ids(col, strict: bool = True) -> Column:
    """Parse a ``.seq`` line.  ``strict`` casts (error on junk); otherwise
    ``try_cast`` leaves a null element that marks the line malformed."""
    toks = ws_tokens(col)
    if strict:
        return F.transform(toks, lambda x: x.cast("int"))
    # a failed cast costs an exception; without a digit it cannot succeed
    return F.transform(toks, lambda x: F.when(x.rlike("[0-9]"), x.try_cast("int")))
