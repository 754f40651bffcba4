"""SQL (DuckDB dialect) counterparts of the column functions, for oracles.
Word lists, patterns and tokens are stated here apart from the engine's, so
that a wrong list shows."""

from __future__ import annotations


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Markup as RE2 patterns; every character reference that the test pages and
# review texts hold ("&amp;" last: a reference is decoded once).
COMMENT_RE = r"(?s)<!--.*?-->"
SCRIPT_RE = r"(?is)<script[^>]*>.*?</script\s*>"
STYLE_RE = r"(?is)<style[^>]*>.*?</style\s*>"
DOCTYPE_RE = r"<![^>]*>"
TAG_RE = r"""</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^'">])*>"""
REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#8217;", "’"),
              ("&eacute;", "é"), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " ")]


def strip_html_sql(x: str) -> str:
    for pattern in (COMMENT_RE, SCRIPT_RE, STYLE_RE, DOCTYPE_RE, TAG_RE):
        x = f"regexp_replace({x}, {q(pattern)}, '', 'g')"
    for name, char in REFERENCES:
        x = f"replace({x}, {q(name)}, {q(char)})"
    return f"lower(replace({x}, '&amp;', '&'))"


# RE2 spellings: RE2 classes are ASCII unless spelled with Unicode
# properties, and `$` without (?m) is the end of the text.
TOKEN_RE_SQL = r"[\p{L}\p{Nl}\p{Nd}\p{M}\p{Pc}]{2,}"
FILE_RE_SQL = r"^[\p{L}\p{Nl}\p{Nd}\p{M}\p{Pc},\s-]+\.[A-Za-z]{3}\n?$"
MISSING = """'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>',
  'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"""


def tokens_sql(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(TOKEN_RE_SQL)})"


def is_url_sql(x: str) -> str:
    return f"coalesce(starts_with({x}, 'http://') OR starts_with({x}, 'https://'), false)"


def is_file_sql(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {q(FILE_RE_SQL)}), false)"


def is_missing_sql(x: str) -> str:
    return f"({x} IS NULL OR {x} IN ({MISSING}))"


def majority_sql(a: str, b: str, c: str) -> str:
    def cnt(lbl):
        return f"len(list_filter([{a}, {b}, {c}], lambda v: v = '{lbl}'))"
    p, n, u = cnt("positive"), cnt("negative"), cnt("neutral")
    return (f"(CASE WHEN {p} > {n} AND {p} >= {u} THEN 'positive' "
            f"WHEN {n} > {p} AND {n} > {u} THEN 'negative' ELSE 'neutral' END)")


_A = """(3, 'adore amazing awesome brilliant excellent fantastic loved love outstanding perfect superb terrific wonderful'),
  (2, 'beautiful best delighted enjoy enjoyed glad good great happy helpful impressed nice pleased reliable'),
  (1, 'clean comfortable easy fair fine ok okay quick solid sturdy works worth'),
  (-1, 'cheap dull flimsy late loud meh noisy slow weak wrong'),
  (-2, 'annoying bad broke broken disappointed disappointing faulty poor scum stupid trash ugly useless'),
  (-3, 'awful disgusting hate hated horrible idiot loser moron pathetic terrible worst worthless')"""
_B = """(8, 'best excellent perfect love loved superb wonderful'),
  (6, 'amazing awesome fantastic good great happy outstanding'),
  (4, 'nice helpful impressed fine better fun easy pleasant'),
  (-4, 'cheap slow weak noisy boring dull late'), (-6, 'bad broken poor disappointing useless stupid trash clown'),
  (-8, 'worst awful terrible horrible hate hated disgusting pathetic worthless')"""


def lexicon_scores_cte(src: str, id_col: str, text_col: str) -> dict[str, str]:
    """CTEs up to `scores(id, grades, eighths, hits)` over ``src``: one row
    per text with tokens; scorer B sees the two tokens before a hit."""
    return {
        "lex_a": f"SELECT unnest(string_split(ws, ' ')) AS w, g FROM (VALUES {_A}) t(g, ws)",
        "lex_b": f"SELECT unnest(string_split(ws, ' ')) AS w, p FROM (VALUES {_B}) t(p, ws)",
        "toks": f"""SELECT id, i, tk[i] AS tok, tk[i - 1] AS w1, CASE WHEN i > 2 THEN tk[i - 2] END AS w2
  FROM (SELECT id, tk, unnest(range(1, len(tk) + 1)) AS i
        FROM (SELECT {id_col} AS id, {tokens_sql(text_col)} AS tk FROM {src} WHERE {text_col} IS NOT NULL) x) y""",
        "strong": """SELECT id, CASE WHEN w1 IN ('very', 'really', 'extremely', 'so', 'truly', 'absolutely')
      THEN sign(p) * least(8, abs(p) * 3 // 2) ELSE p END::BIGINT AS v,
    coalesce(w1 IN ('not', 'no', 'never', 'hardly', 'without'), false)
      OR coalesce(w2 IN ('not', 'no', 'never', 'hardly', 'without'), false) AS turned
  FROM toks JOIN lex_b ON tok = w""",
        "scores": """SELECT id, sum(g)::BIGINT AS grades, sum(e)::BIGINT AS eighths, sum(h)::BIGINT AS hits FROM (
    SELECT id, g, 0 AS e, 0 AS h FROM toks JOIN lex_a ON tok = w
    UNION ALL SELECT id, 0, CASE WHEN turned THEN -(v // 2) ELSE v END, 1 FROM strong) u GROUP BY id""",
    }


def lexicon_a_sql(grades: str, text_col: str) -> str:
    c = f"({grades}::DOUBLE / sqrt({grades}::DOUBLE * {grades}::DOUBLE + 15.0))"
    return (f"(CASE WHEN {text_col} IS NULL THEN NULL WHEN {c} >= 0.05 THEN 'positive' "
            f"WHEN {c} <= -0.05 THEN 'negative' ELSE 'neutral' END)")


def lexicon_b_sql(eighths: str, text_col: str) -> str:
    return (f"(CASE WHEN {text_col} IS NULL THEN NULL WHEN {eighths} > 0 THEN 'positive' "
            f"WHEN {eighths} < 0 THEN 'negative' ELSE 'neutral' END)")
