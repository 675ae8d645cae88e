"""Plan-shape asserts: no nested-loop or cartesian joins, pruned scans."""

import pytest

import __spark_entry__ as E

STREAMING = {"stream_run_counters", "stream_velocity_windows", "stream_review_dedupe"}
LLM = {k for k in E.queries() if k.startswith("op") and k[2].isdigit()} | {"pipeline"}   # tested in tests/llm
LANDING = {"ingest_places", "combine_business", "flatten_reviews"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(E.queries()) - STREAMING - LANDING - LLM))
def test_no_nested_loop_or_cartesian(spark, sf_dir, key):
    plan = _plan(E.queries()[key](spark, sf_dir))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_review_scan_is_pruned(spark, sf_dir):
    """V4 reads only business_id, stars and published_at of the stored reviews."""
    import re
    df = E.queries()["vulnerable_players"](spark, sf_dir)
    df.collect()
    plan = _plan(df)
    schemas = re.findall(r"market-business_reviews[^\n]*?ReadSchema: (struct<[^>]*>)", plan)
    assert schemas, plan[:2000]
    for sch in schemas:
        assert "review_text" not in sch and "reviewer_name" not in sch
        assert "stars" in sch and "published_at" in sch


def test_city_filter_is_pushed_to_the_stored_scan(spark, sf_dir):
    df = E.queries()["city_rating_filter"](spark, sf_dir)
    assert "EqualTo(city,METRO)" in _plan(df).split("PushedFilters: ", 1)[1].split("ReadSchema", 1)[0]


@pytest.mark.parametrize("key", ["pain_pct", "sample_complaints", "complaint_theme_rows", "success_factor_rows"])
def test_no_texts_are_gathered(spark, sf_dir, key):
    assert "collect_list" not in _plan(E.queries()[key](spark, sf_dir))


@pytest.mark.parametrize("key", ["customer_pain_points", "market_leaders", "vulnerable_players",
                                 "review_velocity_trends", "niche_service_gaps", "business_model_opportunities",
                                 "niche_swot_analysis", "business_summary", "sentiment_by_category"])
def test_reviews_are_aggregated_before_any_join(spark, sf_dir, key):
    """The review scan meets a (partial) aggregate before it meets a join: no review-grain join."""
    assert _first_consumer_of_reviews(spark, sf_dir, key) == {"Aggregate"}


def test_plan_walk_detects_review_grain_join(spark, sf_dir):
    """Control: the review-grain listing query does join raw reviews."""
    assert "Join" in _first_consumer_of_reviews(spark, sf_dir, "reviews_with_business")


def _kids(node):
    cls = node.getClass().getSimpleName()
    if cls == "AdaptiveSparkPlanExec":
        return [node.executedPlan()]
    if cls.endswith("QueryStageExec"):
        return [node.plan()]
    if cls == "ReusedExchangeExec":
        return [node.child()]
    ch = node.children()
    return [ch.apply(i) for i in range(ch.size())]


def _first_consumer_of_reviews(spark, sf_dir, key):
    """For every scan of the stored reviews, the first aggregate-or-join above it."""
    df = E.queries()[key](spark, sf_dir)
    df.collect()
    seen = set()

    def walk(node, path):
        cls = node.getClass().getSimpleName()
        if cls == "FileSourceScanExec" and "market-business_reviews" in node.toString():
            kind = "none"
            for anc in reversed(path):
                if "Aggregate" in anc:
                    kind = "Aggregate"
                    break
                if "Join" in anc:
                    kind = "Join"
                    break
            seen.add(kind)
        for k in _kids(node):
            walk(k, path + [cls])

    walk(df._jdf.queryExecution().executedPlan(), [])
    assert seen, "no scan of the stored reviews found"
    return seen
