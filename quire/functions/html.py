"""HTML to text (C1), link extraction (C10) and URL resolution (C11) as
column expressions.

C1 re-aims a per-row third-party extractor as a chain of JVM-side regex
rewrites.  Every pattern avoids back-references, look-arounds and ``\\b`` so
the same text means the same thing in Java regex and in RE2.
"""

from __future__ import annotations

import json
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from quire.functions.text import JAVA_ODD_WS, WS_CLASS, once, py_strip

SP = "[\\t\\n\\f\\r ]"           # HTML whitespace inside tags

# Subtrees that never hold main content.
DROP_TAGS = ["script", "style", "noscript", "nav", "footer", "header", "aside", "form", "svg",
             "head", "template", "iframe"]
# Tags that end a line of text.
BLOCK_TAGS = ["p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "article", "section",
              "blockquote", "pre", "ul", "ol", "table", "title", "body", "main", "dd", "dt"]
# Named entities: the HTML 4 table of the standard library, and &apos;.
ENTITIES = {name: chr(cp) for name, cp in name2codepoint.items()} | {"apos": "'"}
# Our choice: a non-breaking space is an ordinary one in extracted text.
ENTITIES["nbsp"] = " "


def extract_steps() -> list[tuple[str, str]]:
    """The ordered (pattern, replacement) chain of C1."""
    steps = [("(?s)<!--.*?-->", " ")]
    for t in DROP_TAGS:
        steps.append((f"(?is)<{t}(?:{SP}[^>]*)?>.*?</{t}{SP}*>", " "))
    # raw text of an unclosed script or style runs to the end of the page
    steps.append((f"(?is)<(?:script|style)(?:{SP}[^>]*)?>.*\\z", " "))
    word = f'"(?:[^"]*{SP})?ad(?:{SP}[^"]*)?"[^>]*', f"'(?:[^']*{SP})?ad(?:{SP}[^']*)?'[^>]*", f"ad(?:{SP}[^>]*)?"
    for value in word:
        steps.append((f"(?is)<div{SP}(?:[^>]*{SP})?class{SP}*={SP}*{value}>.*?</div{SP}*>", " "))
    steps.append((WS_CLASS + "+", " "))
    steps.append(("(?i)<(?:br|/?(?:" + "|".join(BLOCK_TAGS) + "))(?:[/\\t\\n\\f\\r ][^>]*)?>", "\n"))
    # a tag starts with a letter, "/", "!" or "?": "1 < 2 and 3 > 2" is text
    steps.append(("<[A-Za-z/!?][^>]*>", ""))
    return steps


# The same rewrite in a form that Java runs faster.
JAVA_FORM = {WS_CLASS + "+": JAVA_ODD_WS}

REFERENCE = "^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _hex2(x: Column) -> Column:
    return F.lpad(F.hex(x), 2, "0")


def utf8_char(cp: Column) -> Column:
    """The character with code point ``cp`` (UTF-8 bytes built arithmetically)."""
    b = F.when(cp < 0x80, _hex2(cp)) \
         .when(cp < 0x800, F.concat(_hex2(F.lit(0xC0) + F.shiftright(cp, 6)), _hex2(F.lit(0x80) + F.pmod(cp, F.lit(64))))) \
         .when(cp < 0x10000, F.concat(_hex2(F.lit(0xE0) + F.shiftright(cp, 12)),
                                      _hex2(F.lit(0x80) + F.pmod(F.shiftright(cp, 6), F.lit(64))),
                                      _hex2(F.lit(0x80) + F.pmod(cp, F.lit(64))))) \
         .otherwise(F.concat(_hex2(F.lit(0xF0) + F.shiftright(cp, 18)),
                             _hex2(F.lit(0x80) + F.pmod(F.shiftright(cp, 12), F.lit(64))),
                             _hex2(F.lit(0x80) + F.pmod(F.shiftright(cp, 6), F.lit(64))),
                             _hex2(F.lit(0x80) + F.pmod(cp, F.lit(64)))))
    return F.decode(F.unhex(b), "UTF-8")


def decode_entities(col) -> Column:
    """Named and numeric references, in one pass (``&amp;lt;`` becomes
    ``&lt;``).  Numeric ones may have leading zeros and stand for code points
    1..0x10FFFF outside the surrogate range; anything else stays as written.
    Only texts holding ``&`` are split."""
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")     # folded to a literal

    def piece(p, i):
        ref = F.regexp_extract(p, REFERENCE, 1)
        dec = F.ltrim(F.regexp_extract(ref, "^#([0-9]+)$", 1), F.lit("0"))
        hex_ = F.ltrim(F.regexp_extract(ref, "^#[xX]([0-9a-fA-F]+)$", 1), F.lit("0"))
        cp = F.when((dec != "") & (F.length(dec) <= 7), dec.try_cast("long")) \
              .when((hex_ != "") & (F.length(hex_) <= 6), F.conv(hex_, 16, 10).try_cast("long"))
        ok = (cp >= 1) & (cp <= 0x10FFFF) & ~((cp >= 0xD800) & (cp <= 0xDFFF))
        char = F.when(ref.startswith("#"), F.when(ok, utf8_char(cp))).when(ref != "", F.try_element_at(names, ref))
        return F.when(i == 0, p).otherwise(F.coalesce(F.concat(char, F.regexp_replace(p, REFERENCE, "")),
                                                      F.concat(F.lit("&"), p)))

    def decoded(t):
        return F.when(t.contains("&"), F.array_join(F.transform(F.split(t, "&"), piece), "")).otherwise(t)

    return once(col, decoded)


def extract_text(col) -> Column:
    """Main text of a page, one line per block, ``''`` when nothing is left."""
    c = F.col(col) if isinstance(col, str) else col
    c = reduce(lambda acc, s: F.regexp_replace(acc, JAVA_FORM.get(s[0], s[0]), s[1]), extract_steps(), c)
    c = decode_entities(c)
    c = F.regexp_replace(c, " *\\n[ \\n]*", "\n")
    return py_strip(c)


LINK_RE = (f"(?i)<a(?:{SP}[^>]*?)?{SP}href{SP}*={SP}*"
           f"(\"[^\"]*\"|'[^']*'|[^\\t\\n\\f\\r \"'>]+)")


def extract_links(col) -> Column:
    """Every ``<a href>`` value (double, single or un-quoted), in page
    order, entities decoded."""
    c = F.col(col) if isinstance(col, str) else col
    raw = F.regexp_extract_all(c, F.lit(LINK_RE), 1)
    return F.transform(raw, lambda v: decode_entities(
        F.regexp_replace(v, "^\"(.*)\"$|^'(.*)'$", "$1$2")))


SCHEME_RE = "^([A-Za-z][A-Za-z0-9+.-]*):"


def _remove_dots(segs: Column) -> Column:
    """Resolve '.' and '..' over an array of path segments (as urljoin)."""
    acc = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda a, s: F.when(s == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))))
                      .when(s == ".", a)
                      .otherwise(F.concat(a, F.array(s))))
    last = F.element_at(segs, -1)
    return F.when(last.isin(".", ".."), F.concat(acc, F.array(F.lit("")))).otherwise(acc)


def _parts(u: Column):
    """scheme (lower case), has authority, authority, path, query, fragment
    of a URL; the last two with their mark, '' when empty or absent."""
    scheme = F.lower(F.regexp_extract(u, SCHEME_RE, 1))
    rest = F.regexp_replace(u, SCHEME_RE, "")
    frag = F.regexp_extract(rest, "(?s)(#.+)\\z", 1)
    nofrag = F.regexp_replace(rest, "(?s)#.*\\z", "")
    query = F.regexp_extract(nofrag, "(?s)(\\?.+)\\z", 1)
    bare = F.regexp_replace(nofrag, "(?s)\\?.*\\z", "")
    net = F.regexp_extract(bare, "^//([^/]*)", 1)
    path = F.regexp_replace(bare, "^//[^/]*", "")
    return scheme, net, path, query, frag


def resolve_url(base, href) -> Column:
    """C11: ``urllib.parse.urljoin(base, href)`` for bases with an authority.

    As there, C0 controls and blanks around a link and tabs and line breaks
    inside it go away, the scheme is lower-cased, a link that repeats the
    base's scheme without an authority is relative, and empty queries,
    fragments and authorities count as absent.
    """
    b = F.col(base) if isinstance(base, str) else base
    h = F.col(href) if isinstance(href, str) else href
    raw = h
    h = F.regexp_replace(F.regexp_replace(h, "^[\\x00-\\x20]+|[\\x00-\\x20]+\\z", ""), "[\\t\\r\\n]", "")
    b_scheme, b_net, b_path, b_query, b_frag = _parts(b)
    h_scheme, h_net, h_path, h_query, h_frag = _parts(h)
    prefix = F.concat(b_scheme, F.lit("://"), b_net)

    dirs = F.split(b_path, "/")
    # all but the last segment of the base's path; a path without a last
    # segment ("/dir/") keeps its empty one out of the middle
    merged = F.concat(F.slice(dirs, 1, F.greatest(F.size(dirs) - 1, F.lit(0))), F.split(h_path, "/"))
    n = F.size(merged)
    merged = F.filter(merged, lambda s, i: (s != "") | (i == 0) | (i == n - 1))
    path_rel = F.array_join(_remove_dots(merged), "/")
    path_root = F.array_join(_remove_dots(F.split(h_path, "/")), "/")

    def rooted(p):
        return F.when(p == "", F.lit("/")).when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p))

    def tidy(scheme, net, path):
        """Put a URL back together, without empty marks."""
        return F.concat(scheme, F.lit("://"), net, F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path),
                        h_query, h_frag)

    foreign = (h_scheme != "") & (h_scheme != b_scheme)
    return (F.when(raw == "", b)
             .when(foreign, h)
             .when(h_net != "", tidy(F.when(h_scheme != "", h_scheme).otherwise(b_scheme), h_net, h_path))
             .when(h_path == "", F.concat(prefix, b_path, F.when(h_query != "", h_query).otherwise(b_query), h_frag))
             .when(h_path.startswith("/"), F.concat(prefix, rooted(path_root), h_query, h_frag))
             .otherwise(F.concat(prefix, rooted(path_rel), h_query, h_frag)))
