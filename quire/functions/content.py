"""Main content of nested pages (C1): subtrees by tag nesting, blocks by link
density and text length.

1. Tag events are read in page order.  A dropped element (navigation, script,
   advertisement, ...) ends at its own closing tag: tags of the same name
   inside it are counted.  This is the one step that needs a state per page;
   it runs in Arrow batches, page by page, in time linear in the page.
2. What is left is cut into blocks.  A block goes when more than half of its
   characters are link text, or more than a fifth and it is short; headings
   stay.

Defined results: an element that is never closed reaches to the end of the
page (``head`` ends at ``<body>`` as well); script and style end at their first
closing tag; self-closing tags open nothing; a dropped element leaves a blank; a null page gives null, one
without content ''.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from quire.functions.html import BLOCK_TAGS, DROP_TAGS, SP, decode_entities
from quire.functions.text import WS_CLASS, py_strip

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # workers need no copy of the package

TOKEN = r"<!--[\s\S]*?-->|<[A-Za-z/!?][^>]*>"
# the class attribute of an advertisement: its words hold ``ad``
AD = (f"(?i)^<div{SP}(?:[^>]*{SP})?class{SP}*={SP}*(?:\"(?:[^\"]*{SP})?ad(?:{SP}[^\"]*)?\"|'(?:[^']*{SP})?ad(?:{SP}[^']*)?'"
      f"|ad(?:{SP}|/?>))")
RAW = ["script", "style"]
LINK_SHARE = 2               # a block goes when LINK_SHARE * link text > text ...
SHORT_SHARE, SHORT = 5, 40   # ... or SHORT_SHARE * link text > text and it has fewer than SHORT characters
OPEN, CLOSE, HEAD = "\x01", "\x02", "\x03"       # marks of a link and of a heading
ANCHOR_OPEN, ANCHOR_CLOSE = f"(?i)<a(?:{SP}[^>]*)?>", f"(?i)</a{SP}*>"
HEADING = f"(?i)<h[1-6](?:[/\\t\\n\\f\\r ][^>]*)?>"
BLOCK = "(?i)<(?:br|/?(?:" + "|".join(BLOCK_TAGS) + "))(?:[/\\t\\n\\f\\r ][^>]*)?>"
ANY_TAG = "<[A-Za-z/!?][^>]*>"


def keep_content(html: str, _token=re.compile(TOKEN), _name=re.compile(r"</?([A-Za-z][A-Za-z0-9]*)"), _ad=re.compile(AD)) -> str:
    """The page without its dropped subtrees and comments."""
    out, at, inside, depth = [], 0, None, 0
    for m in _token.finditer(html):
        if inside is None:
            out.append(html[at:m.start()])
        at = m.end()
        tag = m.group()
        named = _name.match(tag)
        name = named.group(1).lower() if named else ""
        closes, alone = tag.startswith("</"), tag.endswith("/>")
        if inside is None:
            if not closes and not alone and (name in DROP_TAGS or _ad.search(tag)):
                inside, depth = name, 1
                out.append(" ")
            else:
                out.append(tag if named else " ")
        elif inside == "head" and name == "body" and not closes:
            inside = None
            out.append(tag)
        elif name == inside:
            if closes:
                depth -= 1
            elif not alone and inside not in RAW:
                depth += 1
            if not depth:
                inside = None
    if inside is None:
        out.append(html[at:])
    return "".join(out)


def without_dropped(col) -> Column:
    """:func:`keep_content` of a column, in Arrow batches."""
    import pyarrow as pa

    def run(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in pages:
            for s in range(0, max(len(a), 1), 256):
                part = a[s:s + 256].to_pylist()
                yield pa.array([None if p is None else keep_content(p) for p in part], pa.string())

    def whole(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in pages:
            yield pa.concat_arrays(list(run([a])))

    whole.__annotations__ = {"pages": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(whole, "string")(F.col(col) if isinstance(col, str) else col)


def block_steps() -> list:
    """(pattern, replacement) chain from a page without dropped subtrees to
    marked text, one line per block."""
    return [(f"[{OPEN}{CLOSE}{HEAD}]", " "), (WS_CLASS + "+", " "), (HEADING, "\n" + HEAD), (BLOCK, "\n"),
            (ANCHOR_OPEN, OPEN), (ANCHOR_CLOSE, CLOSE), (ANY_TAG, "")]


MARKS = f"[{OPEN}{CLOSE}{HEAD} ]"
LINKED = f"{OPEN}([^{CLOSE}]*)"


def main_content(kept) -> Column:
    """Main text of the column :func:`without_dropped` gives, a line per block."""
    c = F.col(kept) if isinstance(kept, str) else kept
    for pattern, by in block_steps():
        c = F.regexp_replace(c, pattern, by)

    def stays(line):
        total = F.length(F.regexp_replace(line, MARKS, ""))
        linked = F.length(F.regexp_replace(F.array_join(F.regexp_extract_all(line, F.lit(LINKED), F.lit(1)), ""), MARKS, ""))
        dense = (linked * LINK_SHARE > total) | (linked * SHORT_SHARE > total) & (total < SHORT)
        return line.startswith(HEAD) | ~dense

    lines = F.filter(F.split(c, "\n"), stays)
    text = F.translate(F.array_join(lines, "\n"), OPEN + CLOSE + HEAD, "")
    return py_strip(F.regexp_replace(decode_entities(text), " *\\n[ \\n]*", "\n"))
