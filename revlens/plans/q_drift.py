"""Registered drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as DR
from ..operators import star as ST
from ..session import materialize
from ..sources import testdata as td
from .catalog import register
from .q_pipeline import _l6
from .q_star import _SRC, _STAR_CTES, _stored
from .sqltext import q, tokens_sql
from .sqlviews import with_views


def _rounded(df):
    """Test statistics to ten digits, as the comparison needs them."""
    return df.withColumns({c: F.round(c, 10) for c in ("ks_stat", "chi2", "p_value") if c in df.columns})


def _freq_sql(table: str, col: str) -> str:
    return (f"SELECT tok AS Feature, COUNT(*) AS Frequency FROM (SELECT unnest({tokens_sql(col)}) AS tok "
            f"FROM {table} WHERE {col} IS NOT NULL) t GROUP BY tok")


def _ks_sql(vals: str, by: str | None) -> dict[str, str]:
    """CTEs ks_cnt, ks_cum, ks_d, ks over `vals(sample, value[, by])`.  Small
    samples count lattice paths: `ks_paths` holds, for i current and j
    reference values, the ways whose gaps all stay below the statistic."""
    b = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    tot_join = f"JOIN ks_tot t ON c.{by} = t.{by}" if by else "CROSS JOIN ks_tot t"
    lam = "(sqrt(n_ref * n_cur / CAST(n_ref + n_cur AS DOUBLE)) * ks_stat)"
    series = (f"(SELECT SUM(CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * j * j * {lam} * {lam})) "
              f"FROM range(1, {DR.KS_TERMS + 1}) r(j))")
    return {
        "ks_cnt": f"""SELECT {b}CAST(value AS DOUBLE) AS v, SUM(CASE WHEN sample = 'reference' THEN 1 ELSE 0 END) AS a,
    SUM(CASE WHEN sample = 'current' THEN 1 ELSE 0 END) AS b FROM {vals} GROUP BY {b}CAST(value AS DOUBLE)""",
        "ks_tot": f"SELECT {b}CAST(SUM(a) AS BIGINT) AS n_ref, CAST(SUM(b) AS BIGINT) AS n_cur FROM ks_cnt"
                  + (f" GROUP BY {by}" if by else ""),
        "ks_cum": f"""SELECT {b}v, SUM(a) OVER ({part}ORDER BY v ROWS UNBOUNDED PRECEDING) AS ca,
    SUM(b) OVER ({part}ORDER BY v ROWS UNBOUNDED PRECEDING) AS cb FROM ks_cnt""",
        "ks_d": f"""SELECT {('t.' + by + ', ') if by else ''}t.n_ref, t.n_cur,
    MAX(abs(c.ca / t.n_ref - c.cb / t.n_cur)) AS ks_stat,
    MAX(abs(c.ca * t.n_cur - c.cb * t.n_ref))::BIGINT AS gap FROM ks_cum c {tot_join}
    GROUP BY {('t.' + by + ', ') if by else ''}t.n_ref, t.n_cur""",
        "ks_small": f"""SELECT {by or '0'} AS g, n_ref, n_cur, gap FROM ks_d
  WHERE greatest(n_ref, n_cur) <= 10000 AND least(n_ref, n_cur) > 0""",
        "ks_cells": """SELECT g, n_ref, n_cur, i, j FROM (
    SELECT *, unnest(range(0, n_ref + 1)) AS j FROM (SELECT *, unnest(range(0, n_cur + 1)) AS i FROM ks_small) x) y
  WHERE abs(i * n_ref - j * n_cur) < gap""",
        "ks_paths": """SELECT g, i, j, 1::DOUBLE AS ways FROM ks_cells WHERE i = 0
  UNION ALL
  SELECT g, i, j, sum(came) OVER (PARTITION BY g ORDER BY j ROWS UNBOUNDED PRECEDING) FROM (
    SELECT c.g, c.i, c.j, coalesce(p.ways, 0) AS came
    FROM (SELECT DISTINCT g, i + 1 AS i FROM ks_paths) s JOIN ks_cells c ON c.g = s.g AND c.i = s.i
    LEFT JOIN ks_paths p ON p.g = c.g AND p.j = c.j) z""",
        "ks_exact": """SELECT s.g, 1.0 - coalesce((SELECT p.ways FROM ks_paths p
      WHERE p.g = s.g AND p.i = s.n_cur AND p.j = s.n_ref), 0) / s.everyway AS p FROM (
    SELECT *, (SELECT product((ks_small.n_ref + x) / x) FROM range(1, ks_small.n_cur + 1) t(x)) AS everyway FROM ks_small) s""",
        "ks": f"""SELECT {b}n_ref, n_cur, round(CASE WHEN n_ref * n_cur > 0 THEN ks_stat END, 10) AS ks_stat,
    round(CASE WHEN n_ref = 0 OR n_cur = 0 THEN NULL WHEN e.p IS NOT NULL THEN least(1.0, e.p) WHEN {lam} < {DR.KS_SMALL_LAMBDA} THEN 1.0
      ELSE least(1.0, greatest(0.0, 2.0 * {series})) END, 10) AS p_value FROM ks_d LEFT JOIN ks_exact e ON e.g = {by or '0'}""",
    }


@register("a18_word_frequencies", _freq_sql("documents", "text"))
def a18(spark, sf):
    """Word-frequency table of all document texts."""
    return DR.word_frequencies(td.table(spark, sf, "documents"), "text")


@register("x1_frequency_drift", with_views(
    "SELECT *, coalesce(p_value < 0.05, false) AS drift_detected FROM ks",
    extra={"f_ref": _freq_sql("documents", "text"), "f_cur": _freq_sql("conversations", "text"),
           "vals": "SELECT 'reference' AS sample, Frequency AS value FROM f_ref "
                   "UNION ALL SELECT 'current', Frequency FROM f_cur",
           **_ks_sql("vals", None)}))
def x1(spark, sf):
    """X1 + X2: KS test between the word-frequency values of the document
    corpus (saved statistics) and the conversation texts (new data)."""
    saved = DR.word_frequencies(td.table(spark, sf, "documents"), "text")
    new = DR.word_frequencies(td.table(spark, sf, "conversations"), "text")
    return _rounded(DR.frequency_drift(saved, new))


@register("x4_missing_baseline", with_views(
    """SELECT CAST(0 AS BIGINT) AS n_ref, COUNT(*) AS n_cur, CAST(NULL AS DOUBLE) AS ks_stat,
  CAST(NULL AS DOUBLE) AS p_value, false AS drift_detected FROM f_cur""",
    extra={"f_cur": _freq_sql("conversations", "text")}))
def x4(spark, sf):
    """No saved statistics -> a 'no baseline' row (null statistic)."""
    new = DR.word_frequencies(td.table(spark, sf, "conversations"), "text")
    return DR.frequency_drift(None, new)


_DESC = """SELECT review_id, CAST(length(cleaned_text) AS DOUBLE) AS text_length,
    CASE WHEN length(cleaned_text) > 0 THEN length(regexp_replace(cleaned_text, '\\p{{L}}', '', 'g')) / length(cleaned_text)
         ELSE 0.0 END AS non_letter_share, cleaned_text FROM {src} WHERE cleaned_text IS NOT NULL"""


def _desc_ctes(src: str, name: str) -> dict[str, str]:
    return {
        f"{name}_b": _DESC.format(src=src),
        f"{name}_t": f"SELECT review_id, unnest({tokens_sql('cleaned_text')}) AS Feature FROM {name}_b",
        f"{name}_o": f"""SELECT t.review_id, SUM(CASE WHEN v.Feature IS NULL THEN 1 ELSE 0 END) / COUNT(*) AS oov_share
    FROM {name}_t t LEFT JOIN (SELECT DISTINCT Feature FROM vocab) v ON t.Feature = v.Feature GROUP BY t.review_id""",
        f"{name}_d": f"""SELECT b.review_id, b.text_length, b.non_letter_share, coalesce(o.oov_share, 0.0) AS oov_share
    FROM {name}_b b LEFT JOIN {name}_o o ON b.review_id = o.review_id""",
        f"{name}_l": f"""SELECT '{name}' AS sample, descriptor, value FROM (UNPIVOT {name}_d
    ON text_length, non_letter_share, oov_share INTO NAME descriptor VALUE value) u""",
    }


@register("x5_descriptor_drift", with_views(f"""SELECT descriptor, n_ref, n_cur, ks_stat, p_value,
  coalesce(p_value < 0.05, false) AS drifted FROM ks
UNION ALL SELECT 'dataset', MIN(n_ref), MIN(n_cur), NULL, MIN(p_value),
  CAST(MAX(CAST(coalesce(p_value < 0.05, false) AS INTEGER)) AS BOOLEAN) FROM ks""", *_SRC, extra={
    **_STAR_CTES,
    "refw": "SELECT * FROM fact WHERE review_id BETWEEN 1 AND 500",
    "curw": "SELECT * FROM fact ORDER BY review_id DESC LIMIT 5",
    "vocab": _freq_sql("refw", "cleaned_text"),
    **_desc_ctes("refw", "reference"), **_desc_ctes("curw", "current"),
    "vals": "SELECT * FROM reference_l UNION ALL SELECT * FROM current_l",
    **_ks_sql("vals", "descriptor")}))
def x5(spark, sf):
    """X5 + X7 + K2 + K3: text-descriptor drift of the latest 5 reviews
    against reviews 1..500 (vocabulary = words of the reference window)."""
    # both windows come from the stored star: pruned by id, then kept once
    fact = _stored(spark, sf)[2].select("review_id", "cleaned_text")
    ref = materialize(ST.reference_window(fact, 1, 500))
    cur = materialize(ST.latest_reviews(fact, 5))
    vocab = DR.word_frequencies(ref, "cleaned_text")
    return _rounded(DR.descriptor_drift(ref, cur, "cleaned_text", vocab, "review_id"))


_X6 = """SELECT user_id, event_id, ts, CAST((rn - 1) % 10 AS INTEGER) AS drift_counter,
  (rn > 1 AND (rn - 1) % 10 = 0) AS triggered FROM (
  SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type = 'error') t"""


def _x6(spark, sf):
    ev = td.table(spark, sf, "events").filter(F.col("event_type") == "error").select("user_id", "event_id", "ts")
    return DR.drift_counter(ev, "user_id", "ts", "event_id")


@register("x6_drift_counter", _X6)
def x6(spark, sf):
    """Drift counter and retrain trigger per stream key (error events
    of each user are that stream's drift events)."""
    return _x6(spark, sf)


@register("w5_latest_counter", f"""SELECT user_id, drift_counter, ts AS inserted_datetime FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM ({_X6}) a) b
WHERE k = 1""")
def w5(spark, sf):
    """Latest counter row per key."""
    c = _x6(spark, sf).withColumnRenamed("ts", "inserted_datetime")
    return DR.latest_counter(c, "user_id", "inserted_datetime", "drift_counter", tiebreak="event_id")


@register("x8_label_drift", with_views("""SELECT round(chi2, 10) AS chi2, 2 AS dof, round(exp(-chi2 / 2.0) * 1.0, 10) AS p_value,
  round(exp(-chi2 / 2.0) * 1.0, 10) < 0.05 AS drifted FROM (
  SELECT SUM(CASE WHEN er > 0 THEN pow(o_r - er, 2) / er ELSE 0.0 END
           + CASE WHEN ec > 0 THEN pow(o_c - ec, 2) / ec ELSE 0.0 END) AS chi2 FROM (
    SELECT o_r, o_c, (o_r + o_c) * nr / (nr + nc) AS er, (o_r + o_c) * nc / (nr + nc) AS ec FROM (
      SELECT o_r, o_c, SUM(o_r) OVER () AS nr, SUM(o_c) OVER () AS nc FROM (
        SELECT l, CAST(SUM(r) AS DOUBLE) AS o_r, CAST(SUM(c) AS DOUBLE) AS o_c FROM (
          SELECT final_sentiment AS l, 1 AS r, 0 AS c FROM reviews_v
          UNION ALL SELECT final_sentiment, 0, 1 FROM l6) u
        GROUP BY l) h) h2) h3) h4""",
    "reviews_v", *_SRC, extra=_STAR_CTES))
def x8(spark, sf):
    """Label-histogram drift (chi-square) between the rating-rule labels
    of the numeric reviews and the voted labels of the text reviews."""
    return _rounded(DR.label_drift(td.review_facts(spark, sf), _l6(spark, sf), "final_sentiment"))


@register("x3_save_statistics", _freq_sql("conversations", "text"))
def x3(spark, sf):
    """The saved statistics are replaced by committing a new version
    beside the one being read; the reader finds the newest by itself."""
    from ..session import scratch_path
    base = scratch_path(spark, "word-stats")
    DR.save_statistics(DR.word_frequencies(td.table(spark, sf, "documents"), "text"), base, "first")
    DR.save_statistics(DR.word_frequencies(td.table(spark, sf, "conversations"), "text"), base, "second")
    return DR.latest_statistics(spark, base)
