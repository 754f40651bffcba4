"""Registered sampling / splitting / balancing queries (M1-M6, M8-M10, K4-K7,
J3, U1, U2, A16, A19) over the labeled numeric reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as M
from ..session import materialize
from ..sources import testdata as td
from .catalog import register
from .sqlviews import RANKED_VIEWS, with_views

LV = ("labeled_v",)


def _lab(spark, sf):
    # The labeled review table is the stored input of the sampling jobs that
    # read it more than once (counts, ranks, guards): written once to the
    # checkpoint folder, then read by all branches.
    return materialize(td.labeled_facts(spark, sf))


def _lab_once(spark, sf):
    """The same table as a lazy plan, for jobs that read it once: writing
    it first would only add a round trip through storage."""
    return td.labeled_facts(spark, sf)


def _lab_counts(spark, sf):
    """The labeled table without row ids, for jobs that only count."""
    return td.labeled_facts(spark, sf, row_ids=False)


def _ranked_once(spark, sf):
    """The labeled reviews with their rank as row id, which `ranked_facts`
    has written already."""
    return td.ranked_facts(spark, sf)


def _ranked(spark, sf):
    """The same table written as a whole, for jobs that read it more than once."""
    return materialize(td.ranked_facts(spark, sf))


@register("m1_per_class_sample", with_views("""SELECT row_id, label,
  CAST(row_number() OVER (ORDER BY md5('43:' || row_id), row_id) - 1 AS BIGINT) AS new_index
FROM (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || row_id), row_id) AS rn
      FROM labeled_v) s
WHERE rn <= 100""", *LV, views=RANKED_VIEWS))
def m1(spark, sf):
    """M1 + K6 + K7: 100 rows per class, shuffled and renumbered."""
    return M.per_class_sample(_ranked(spark, sf), n=100).select("row_id", "label", "new_index")


@register("m2_capped_sample", with_views("""SELECT row_id, main_category FROM (
  SELECT row_id, main_category,
         row_number() OVER (PARTITION BY main_category ORDER BY md5('42:' || row_id), row_id) AS rn
  FROM labeled_v WHERE main_category IS NOT NULL) s WHERE rn <= 30""", *LV, views=RANKED_VIEWS))
def m2(spark, sf):
    """M2: up to 30 rows per category."""
    return M.capped_sample(_ranked_once(spark, sf), "main_category", 30).select("row_id", "main_category")


@register("m3_stratified_union", with_views("""SELECT DISTINCT row_id, main_category, store FROM (
  SELECT row_id, main_category, store, row_number() OVER (
    PARTITION BY main_category, row_id // 100000 ORDER BY md5('42:' || row_id), row_id) AS rn
  FROM labeled_v WHERE main_category IS NOT NULL) a WHERE rn <= 50
UNION
SELECT DISTINCT row_id, main_category, store FROM (
  SELECT row_id, main_category, store, row_number() OVER (
    PARTITION BY store, row_id // 100000 ORDER BY md5('42:' || row_id), row_id) AS rn
  FROM labeled_v WHERE store IS NOT NULL) b WHERE rn <= 50""", *LV, views=RANKED_VIEWS))
def m3(spark, sf):
    """M3 + U1 + U2: 50 per category and 50 per store per 100k chunk, union, distinct."""
    d = _ranked(spark, sf).select("row_id", "main_category", "store")
    return M.stratified_union(d, ["main_category", "store"], k=50)


@register("m4_three_way_split", with_views("""SELECT row_id, label,
  CASE WHEN rn <= 6666 THEN 'train' WHEN rn <= 6666 + t THEN 'test' ELSE 'inference' END AS split
FROM (SELECT row_id, label,
             row_number() OVER (PARTITION BY label ORDER BY md5('42:' || row_id), row_id) AS rn,
             floor(0.2 * ((SELECT count(*) FROM labeled_v) - 19998) / 3) AS t
      FROM labeled_v) s""", *LV, views=RANKED_VIEWS))
def m4(spark, sf):
    """M4: balanced train / test / inference split."""
    return M.three_way_split(_ranked(spark, sf)).select("row_id", "label", "split")


@register("m5_random_rows", with_views(
    "SELECT row_id FROM labeled_v ORDER BY md5('42:' || row_id), row_id LIMIT 10000", *LV))
def m5(spark, sf):
    """M5: simple random sample of 10 000 rows."""
    return M.random_rows(_lab_once(spark, sf), 10000).select("row_id")


@register("m6_train_validation_split", with_views("""SELECT row_id,
  CASE WHEN row_number() OVER (ORDER BY md5('42:' || row_id), row_id) <= ceil(0.2 * (SELECT count(*) FROM labeled_v))
       THEN 'validation' ELSE 'train' END AS split
FROM labeled_v""", *LV))
def m6(spark, sf):
    """M6: exact 80/20 train / validation split."""
    return M.train_validation_split(_lab(spark, sf)).select("row_id", "split")


_M8_CTES = {
    "cnt": "SELECT main_category, label, COUNT(*) AS n FROM labeled_v GROUP BY main_category, label",
    "tgt": "SELECT *, max(n) OVER (PARTITION BY main_category) AS target FROM cnt",
    "keep": """SELECT l.row_id, l.main_category, l.label, CAST(NULL AS BIGINT) AS slot
  FROM labeled_v l JOIN tgt t ON l.main_category = t.main_category AND l.label = t.label WHERE t.n = t.target""",
    "slots0": """SELECT main_category, label, n, unnest(generate_series(1, target)) AS slot
  FROM tgt WHERE n < target""",
    "slots": """SELECT main_category, label, slot,
  1 + (('0x' || substr(md5('42:' || main_category || ':' || label || ':' || slot), 1, 15))::BIGINT % n) AS rn
  FROM slots0""",
    "ranked": """SELECT row_id, main_category, label,
  row_number() OVER (PARTITION BY main_category, label ORDER BY row_id) AS rn FROM labeled_v""",
    "balanced": """SELECT * FROM keep UNION ALL
  SELECT r.row_id, r.main_category, r.label, s.slot FROM slots s
  JOIN ranked r ON r.main_category = s.main_category AND r.label = s.label AND r.rn = s.rn""",
}


def _m8(labeled):
    return M.oversample(labeled.select("row_id", "main_category", "label"), "main_category", "label")


@register("m8_oversample", with_views("SELECT * FROM balanced", *LV, extra=_M8_CTES, views=RANKED_VIEWS))
def m8(spark, sf):
    """M8: oversample smaller labels to each category's largest label count."""
    return _m8(_ranked(spark, sf))


@register("m9_category_weights", with_views("""SELECT main_category, COUNT(*) AS n,
  CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS sample_weight
FROM balanced GROUP BY main_category""", *LV, extra=_M8_CTES))
def m9(spark, sf):
    """M9: category sample weights over the balanced rows."""
    return M.group_weights(_m8(_lab(spark, sf)), "main_category")


@register("m10_class_weights", with_views("""SELECT label, COUNT(*) AS n,
  CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (CAST(COUNT(*) OVER () AS DOUBLE) * CAST(COUNT(*) AS DOUBLE)) AS class_weight
FROM labeled_v GROUP BY label""", *LV))
def m10(spark, sf):
    """Balanced class weights."""
    return M.class_weights(_lab_counts(spark, sf), "label")


@register("a19_max_label_count", with_views("""SELECT main_category, MAX(n) AS max_label_count FROM (
  SELECT main_category, label, COUNT(*) AS n FROM labeled_v GROUP BY 1, 2) t GROUP BY main_category""", *LV))
def a19(spark, sf):
    """Largest label count per category."""
    return M.max_label_count(_lab_counts(spark, sf))


@register("a16_first_seen_order", with_views("""SELECT store, MIN(row_id) AS first_row_id,
  CAST(row_number() OVER (ORDER BY MIN(row_id)) AS BIGINT) AS first_seen_rank
FROM labeled_v WHERE store IS NOT NULL GROUP BY store""", *LV, views=RANKED_VIEWS))
def a16(spark, sf):
    """Distinct stores in first-appearance order."""
    return M.first_seen(_ranked_once(spark, sf), "store")


@register("k4_position_slices", with_views("""SELECT row_id,
  CASE WHEN row_id < 5000 THEN 'train' WHEN row_id < 6000 THEN 'test' ELSE 'holdout' END AS slice
FROM labeled_v WHERE (row_id >= 0 AND row_id < 5000) OR (row_id >= 5000 AND row_id < 6000)
   OR (row_id >= 10000 AND row_id < 11000)""", *LV))
def k4(spark, sf):
    """K4: positional slices [0,5000) train, [5000,6000) test, [10000,11000) holdout."""
    d = _lab_once(spark, sf).select("row_id")
    return M.position_slices(d, {"train": (0, 5000), "test": (5000, 6000), "holdout": (10000, 11000)})


@register("j3_remove_sampled", with_views("""SELECT row_id FROM labeled_v WHERE row_id NOT IN (
  SELECT row_id FROM labeled_v ORDER BY md5('42:' || row_id), row_id LIMIT 10000)""", *LV))
def j3(spark, sf):
    """The rows left after removing the M5 sample (anti join by id)."""
    d = _lab(spark, sf).select("row_id")
    return M.remove_rows(d, M.random_rows(d, 10000))


@register("u1_union_by_class", with_views("""SELECT row_id, label FROM labeled_v WHERE label = 0
UNION ALL SELECT row_id, label FROM labeled_v WHERE label = 1
UNION ALL SELECT row_id, label FROM labeled_v WHERE label = 2""", *LV, views=RANKED_VIEWS))
def u1(spark, sf):
    """Per-class frames put back together with a by-name union."""
    d = _ranked(spark, sf).select("row_id", "label")
    return M.union_all(*[d.filter(F.col("label") == k) for k in (0, 1, 2)])


@register("u2_distinct_rows", with_views(
    "SELECT DISTINCT main_category, label, rating FROM labeled_v", *LV))
def u2(spark, sf):
    """Distinct rows over all columns."""
    return M.distinct_rows(_lab_counts(spark, sf).select("main_category", "label", "rating"))
