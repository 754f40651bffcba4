"""Plan properties that matter at scale (checked on the executed plan)."""

from revlens.operators import sampling as M
from revlens.sources import testdata as td

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _broadcast_subtrees(plan: str):
    def indent(line):
        return len(line) - len(line.lstrip(" :+-"))
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            d, sub = indent(line), []
            for nxt in lines[i + 1:]:
                if indent(nxt) <= d:
                    break
                sub.append(nxt)
            yield "\n".join(sub)


def test_oversample_slots_never_broadcast(spark):
    # the generated slots are as many as the oversampled rows; their size is
    # unknown to the planner, so they must not become a broadcast side
    d = td.labeled_facts(spark, SF).select("row_id", "main_category", "label")
    plan = _plan(M.oversample(d))
    assert "SortMergeJoin" in plan
    assert not any("explode(sequence" in s for s in _broadcast_subtrees(plan))
    assert "REPARTITION_BY_NUM" in plan


def test_stored_star_lookups_are_pruned(spark):
    from revlens.operators import star as ST
    from revlens.plans.q_star import _stored
    _, prods, revs = _stored(spark, SF)
    of_category = _plan(ST.products_of(prods, 1))
    assert "PartitionFilters: [isnotnull(category_id" in of_category
    window = _plan(ST.reference_window(revs, 1, 500))
    assert "PushedFilters: [IsNotNull(review_id), GreaterThanOrEqual(review_id,1)" in window
    one = _plan(ST.product_details(prods, revs, 1)[1])
    assert "EqualTo(product_id,1)" in one


def test_label_drift_for_any_number_of_labels(spark):
    import math
    from revlens.operators import drift as DR
    for k in (1, 2, 4, 7):
        ref = spark.range(700).selectExpr(f"CAST(id % {k} AS STRING) AS l")
        cur = spark.range(500).selectExpr(f"CASE WHEN id < 60 THEN '0' ELSE CAST(id % {k} AS STRING) END AS l")
        r = DR.label_drift(ref, cur, "l").first()
        assert r.dof == k - 1
        x = r.chi2
        want = {1: 1.0, 2: math.erfc(math.sqrt(x / 2)),
                4: math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2),
                7: math.exp(-x / 2) * (1 + x / 2 + x * x / 8)}[k]
        assert abs(r.p_value - want) < 1e-10
    with_null = spark.range(10).selectExpr("CASE WHEN id > 4 THEN 'a' END AS l")
    assert DR.label_drift(with_null, with_null, "l").first().dof == 1
