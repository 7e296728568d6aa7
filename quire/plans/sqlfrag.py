"""DuckDB SQL fragments mirroring the column functions, for the oracle
queries.  They reuse the very same pattern strings as the Spark side."""

from __future__ import annotations

from quire.functions import content as C
from quire.functions.html import ENTITIES, LINK_RE, extract_steps
from quire.functions.text import (BREAK_RE, NON_WS_CLASS, PY_WHITESPACE, TRAILING_BREAK_RE)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS_CHARS = "(" + "||".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {q(TRAILING_BREAK_RE)}, ''), {q(BREAK_RE)}, ' ', 'g')"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {q(NON_WS_CLASS + '+')})"


def token_count(x: str) -> str:
    return f"CAST(len({tokens(x)}) AS BIGINT)"


WORD = "[\\p{L}\\p{N}_]"
# the plain forms of the rules, for RE2 (no look-around, linear by itself)
SCRUB_RE2 = {
    "email": ("[\\p{L}\\p{N}_.-]+@[\\p{L}\\p{N}_.-]+", "<EMAIL>"),
    "phone": ("\\+?\\p{Nd}[\\p{Nd} ()-]{7,}\\p{Nd}", "<PHONE>"),
}
IP_RE2 = "(^|[^\\p{L}\\p{N}_])\\p{Nd}{1,3}(?:-\\p{Nd}{1,3}){2},(" + WORD + ")"


def scrub_rule(x: str, name: str) -> str:
    if name == "ip":
        # RE2 has no look-around: keep the neighbours as groups; a second pass
        # catches matches that share a neighbour with the previous one.
        once = f"regexp_replace({x}, {q(IP_RE2)}, '\\1<IP>\\2', 'g')"
        return f"regexp_replace({once}, {q(IP_RE2)}, '\\1<IP>\\2', 'g')"
    pat, rep = SCRUB_RE2[name]
    return f"regexp_replace({x}, {q(pat)}, {q(rep)}, 'g')"


def scrub(x: str) -> str:
    for n in ("ip", "email", "phone"):
        x = scrub_rule(x, n)
    return x


NAMES_SQL = "MAP {" + ", ".join(f"'{k}': {q(v)}" for k, v in ENTITIES.items()) + "}"


def decode_entities(x: str) -> str:
    """Character references by a list of pieces; code points by arithmetic on
    the digits, not by the patterns of the Spark side."""
    ref = "regexp_extract(p, '^([#A-Za-z0-9]+);', 1)"
    dec = f"regexp_extract({ref}, '^#0*([1-9][0-9]{{0,6}})$', 1)"
    hx = f"regexp_extract({ref}, '^#[xX]0*([1-9a-fA-F][0-9a-fA-F]{{0,5}})$', 1)"
    cp = f"(CASE WHEN {dec} <> '' THEN CAST({dec} AS BIGINT) WHEN {hx} <> '' THEN CAST(('0x' || {hx}) AS BIGINT) END)"
    num = f"(CASE WHEN {cp} BETWEEN 1 AND 55295 OR {cp} BETWEEN 57344 AND 1114111 THEN chr(CAST({cp} AS INTEGER)) END)"
    name = f"({NAMES_SQL})[{ref}]"
    char = f"(CASE WHEN starts_with({ref}, '#') THEN {num} WHEN {ref} <> '' THEN {name} END)"
    piece = f"CASE WHEN i = 1 THEN p ELSE coalesce({char} || substr(p, length({ref}) + 2), '&' || p) END"
    out = f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {piece}), '')"
    return f"(CASE WHEN contains({x}, '&') THEN {out} ELSE {x} END)"


def extract_text(x: str) -> str:
    for pat, rep in extract_steps():
        r = "chr(10)" if rep == "\n" else q(rep)
        x = f"regexp_replace({x}, {q(pat)}, {r}, 'g')"
    x = decode_entities(x)
    x = f"regexp_replace({x}, {q(' *' + chr(10) + '[ ' + chr(10) + ']*')}, chr(10), 'g')"
    return strip(x)


def keep_content(x: str) -> str:
    """A page without dropped subtrees: a fold over its pieces (tags, comments
    and the text between them) with the open element and its depth."""
    name = "lower(regexp_extract(e.t, '^</?([A-Za-z][A-Za-z0-9]*)', 1))"
    drop = "(" + ", ".join(q(t) for t in C.DROP_TAGS) + ")"
    opens = f"(e.t LIKE '<%' AND e.t NOT LIKE '</%' AND e.t NOT LIKE '%/>' AND {name} <> '')"
    starts = f"({opens} AND ({name} IN {drop} OR regexp_matches(e.t, {q(C.AD)})))"
    other = f"(e.t LIKE '<%' AND length(e.t) > 1 AND {name} = '')"            # comments, declarations
    body = f"(a.d = 'head' AND {name} = 'body' AND {opens})"
    raw = "a.d IN ('script', 'style')"
    depth = f"(a.n + CASE WHEN {name} <> a.d THEN 0 WHEN e.t LIKE '</%' THEN -1 WHEN {opens} AND NOT {raw} THEN 1 ELSE 0 END)"
    step = (f"CASE WHEN a.d = '' AND {starts} THEN {{'t': '', 'd': {name}, 'n': 1, 'o': a.o || ' '}} "
            f"WHEN a.d = '' THEN {{'t': '', 'd': '', 'n': 0, 'o': a.o || CASE WHEN {other} THEN ' ' ELSE e.t END}} "
            f"WHEN {body} THEN {{'t': '', 'd': '', 'n': 0, 'o': a.o || e.t}} "
            f"ELSE {{'t': '', 'd': CASE WHEN {depth} = 0 THEN '' ELSE a.d END, 'n': {depth}, 'o': a.o}} END")
    pieces = f"regexp_extract_all({x}, {q(C.TOKEN + '|[^<]+|<')})"
    first = "{'t': '', 'd': '', 'n': 0, 'o': ''}"
    return (f"list_reduce(list_prepend({first}, list_transform({pieces}, lambda piece: {{'t': piece, 'd': '', 'n': 0, 'o': ''}})), "
            f"lambda a, e: {step}).o")


def main_content(x: str) -> str:
    for pat, rep in C.block_steps():
        r = "||".join(f"chr({ord(c)})" for c in rep) if rep else "''"
        x = f"regexp_replace({x}, {q(pat)}, {r}, 'g')"
    size = "length(regexp_replace({0}, " + q(C.MARKS) + ", '', 'g'))"
    total = size.format("l")
    linked = size.format(f"array_to_string(regexp_extract_all(l, {q(C.LINKED)}, 1), '')")
    dense = f"({linked} * {C.LINK_SHARE} > {total} OR {linked} * {C.SHORT_SHARE} > {total} AND {total} < {C.SHORT})"
    text = f"array_to_string(list_filter(string_split({x}, chr(10)), lambda l: starts_with(l, chr(3)) OR NOT {dense}), chr(10))"
    text = decode_entities(f"translate({text}, chr(1)||chr(2)||chr(3), '')")
    return strip(f"regexp_replace({text}, {q(' *' + chr(10) + '[ ' + chr(10) + ']*')}, chr(10), 'g')")


def links(x: str) -> str:
    inner = decode_entities("regexp_replace(v, " + q("^\"(.*)\"$|^'(.*)'$") + ", '\\1\\2')")
    return f"list_transform(regexp_extract_all({x}, {q(LINK_RE)}, 1), lambda v: {inner})"


BLANKS = "(" + "||".join(f"chr({c})" for c in range(1, 33)) + ")"
SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"


def _remove_dots(segs: str) -> str:
    red = (f"list_reduce({segs}, lambda a, s: CASE WHEN s = '..' THEN a[1:greatest(len(a) - 1, 0)] "
           f"WHEN s = '.' THEN a ELSE list_append(a, s) END, []::VARCHAR[])")
    return f"(CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({red}, '') ELSE {red} END)"


def resolve_url(b: str, h: str) -> str:
    """Links of the driver's pages are root paths, relative paths, queries and
    fragments; the SQL covers those and absolute ones."""
    b_scheme = f"regexp_extract({b}, {q(SCHEME)}, 1)"
    b_rest = f"regexp_replace({b}, {q(SCHEME)}, '')"
    b_net = f"regexp_extract({b_rest}, '^//([^/?#]*)', 1)"
    b_tail = f"regexp_replace({b_rest}, '^//[^/?#]*', '')"
    b_path = f"regexp_extract({b_tail}, '^([^?#]*)', 1)"
    b_query = f"regexp_extract({b_tail}, '^[^?#]*(\\?[^#]+)?', 1)"
    h = f"regexp_replace(trim({h}, {BLANKS}), '[\\t\\r\\n]', '', 'g')"
    h_scheme = f"regexp_extract({h}, {q(SCHEME)}, 1)"
    h_frag = f"regexp_extract({h}, '(#.+)$', 1)"
    h_nofrag = f"regexp_replace({h}, '#.*$', '')"
    h_path = f"regexp_extract({h_nofrag}, '^([^?]*)', 1)"
    h_query = f"regexp_extract({h_nofrag}, '(\\?.+)$', 1)"
    prefix = f"({b_scheme} || '://' || {b_net})"
    bsplit = f"string_split({b_path}, '/')"
    base_dir = f"{bsplit}[1:greatest(len({bsplit}) - 1, 0)]"
    merged0 = f"list_concat({base_dir}, string_split({h_path}, '/'))"
    merged = f"list_filter({merged0}, lambda s, i: s <> '' OR i = 1 OR i = len({merged0}))"
    path_rel = f"array_to_string({_remove_dots(merged)}, '/')"
    path_root = f"array_to_string({_remove_dots('string_split(' + h_path + ', ' + q('/') + ')')}, '/')"

    def with_root(p):
        return f"(CASE WHEN {p} = '' THEN '/' WHEN starts_with({p}, '/') THEN {p} ELSE '/' || {p} END)"

    return (f"(CASE WHEN {h} = '' THEN {b} "
            f"WHEN {h_scheme} <> '' THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {b_scheme} || ':' || {h} "
            f"WHEN {h_path} = '' THEN {prefix} || {b_path} || "
            f"(CASE WHEN {h_query} <> '' THEN {h_query} ELSE {b_query} END) || {h_frag} "
            f"WHEN starts_with({h_path}, '/') THEN {prefix} || {with_root(path_root)} || {h_query} || {h_frag} "
            f"ELSE {prefix} || {with_root(path_rel)} || {h_query} || {h_frag} END)")


def origin(u: str) -> str:
    return f"regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


def host(u: str) -> str:
    return f"split_part(split_part(split_part(split_part({u}, '://', 2), '/', 1), '?', 1), '#', 1)"


# ---------------------------------------------------------------- CRC-32
# DuckDB has no CRC-32: the table of the reflected polynomial by its rule (one
# row, ``crc_table(tbl)``) and the checksum of a string as a fold over its bytes
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list_transform(range(0, 256), lambda n: list_reduce(
  list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
  lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl)"""


def crc32(col: str) -> str:
    """CRC-32 of a string column; needs ``tbl`` of :data:`CRC_TABLE` in scope."""
    data = f"list_transform(range(0, strlen({col})), lambda i: CAST('0x' || substr(hex({col}), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(4294967295, {data}), "
            f"lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295)")
