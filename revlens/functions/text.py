"""Text predicates and transforms (C1, C3, C4, C5, P9-P11, A18 tokens)."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- fixed values -----------------------------------------------------------
# pandas' default missing-value tokens for read_csv (C5): after a CSV hop a
# cell holding exactly one of these strings becomes missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Patterns of the review filters (C3, C4) and the metric-safe name.
URL_PATTERN = r"^https?://"
FILE_NAME_PATTERN = r"(?U)^[\w,\s-]+\.[A-Za-z]{3}\n?\z"
METRIC_NAME_UNSAFE = r"[^a-zA-Z0-9_:/-]"
# Word tokens of two or more word characters (A18, lexicon scoring).
TOKEN_PATTERN = r"(?U)\b\w\w+\b"
# The characters Python's str.strip() removes (str.isspace), as a regex class
# body; the \x{...} form means the same in Java regex and RE2 (P10).
PY_WHITESPACE = (r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
                 r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# ---------------------------------------------------------------------------

# Markup that strip_html (C1) removes: comments, declarations, script and
# style with their bodies, tags (">" may stand in quoted attributes).
_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style)\b(?:"[^"]*"|'[^']*'|[^'">])*+>.*?(?:</\1\s*>|\Z)"""
                     r"""|</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^'">])*+>|<[!?][^>]*>|</?[a-zA-Z][^>]*>""", re.S | re.I)


def _text_of(page: str) -> str:
    return html.unescape(_MARKUP.sub("", page))


def strip_html(col) -> Column:
    """Remove markup, decode every named and numeric character reference
    once, then lower-case (null stays null).

    References need a parser's table, so texts with ``<`` or ``&`` go through
    an Arrow UDF in batches; all others stay in the JVM.  The UDF is marked
    non-deterministic only so that filters on its result reuse it instead of
    running it again."""
    src = _c(col).cast("string")

    @F.pandas_udf("string")
    def decode(pages: pd.Series) -> pd.Series:
        return pages.map(_text_of, na_action="ignore")

    marked = (F.instr(src, "<") > 0) | (F.instr(src, "&") > 0)
    return F.lower(F.coalesce(decode.asNondeterministic()(F.when(marked, src)), src))


def is_blank(col) -> Column:
    """P10: True when the text is empty after a Python-style strip, i.e. it
    holds no character outside Python's whitespace set (null -> null).  The
    search stops at the first non-whitespace character."""
    return ~_c(col).rlike(f"[^{PY_WHITESPACE}]")


def is_url(col) -> Column:
    """C3 predicate: text starts with http:// or https:// (null -> False)."""
    return F.coalesce(_c(col).rlike(URL_PATTERN), F.lit(False))


def is_file_name(col) -> Column:
    """C4 predicate: the whole text looks like `name.ext` (null -> False)."""
    return F.coalesce(_c(col).rlike(FILE_NAME_PATTERN), F.lit(False))


def is_missing_text(col) -> Column:
    """C5 predicate: null, or a token a CSV reader would turn into missing."""
    c = _c(col)
    return c.isNull() | c.isin(NA_TOKENS)


def metric_safe(col) -> Column:
    """Replace characters unsafe in metric names with `_`."""
    return F.regexp_replace(_c(col), METRIC_NAME_UNSAFE, "_")


def word_tokens(col) -> Column:
    """Lower-cased tokens of >= 2 word characters, as an array."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TOKEN_PATTERN), 0)
