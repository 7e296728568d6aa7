"""Column -> Column functions (scalar text operations, all JVM-side)."""

from quire.functions.text import (  # noqa: F401
    collapse_lines, is_blank, py_strip, split_lines, token_count, ws_tokens,
    content_hash, ids_to_text, text_to_ids, PY_WHITESPACE, LINE_BREAKS,
)
from quire.functions.pii import scrub, scrub_rule, RULES  # noqa: F401
