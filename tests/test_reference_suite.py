"""The reference's seven test categories, re-expressed on the derived tables.

Each test names the category/number it mirrors; values are checked by
semantics (counts agree, rules hold) rather than by the 10-row fixture.
"""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import __spark_entry__ as E
from marketlens.operators import quality as Q
from marketlens.plans.catalog import register_market
from marketlens.sources import fixture as fx
from marketlens.sources import warehouse as W


def q(spark, sf_dir, key):
    return E.queries()[key](spark, sf_dir)


def dq(spark, sf_dir):
    return {r["rule"]: r["value"] for r in q(spark, sf_dir, "dq_report").collect()}


# 1 database health -----------------------------------------------------------------
def test_1_1_and_1_4_tables_and_views_exist(spark, sf_dir):
    names = set(register_market(spark, sf_dir))
    assert {"businesses", "business_reviews", "market_executions", "niche_opportunities",
            "niche_swot_analysis", "recent_executions"} <= names


def test_1_5_generated_columns_equal_document(spark, sf_dir):
    assert dq(spark, sf_dir)["generated_mismatch"] == 0


def test_1_6_foreign_keys_hold_in_store_and_are_checked_on_arrival(spark, sf_dir):
    b, r, e = W.businesses(spark, sf_dir), W.reviews(spark, sf_dir), W.executions(spark, sf_dir)
    assert Q.fk_orphans(r, b, "business_id").count() == 0 and Q.fk_orphans(b, e, "execution_id").count() == 0
    assert q(spark, sf_dir, "fk_orphans").count() > 0
    assert q(spark, sf_dir, "orphan_reviews").count() > 0


def test_1_7_check_constraint_rejects_out_of_range(spark, sf_dir):
    rejected = q(spark, sf_dir, "validate_stars").collect()
    assert rejected and all(r["stars"] == 99 for r in rejected)


def test_1_8_full_text_search_finds_parking(spark, sf_dir):
    assert q(spark, sf_dir, "fts_term").count() > 0


# 2 data collection -----------------------------------------------------------------
def test_2_1_and_2_6_run_counters_equal_actual_rows(spark, sf_dir):
    rows = q(spark, sf_dir, "run_totals_check").collect()
    assert all(r["total_businesses"] == r["actual_businesses"] for r in rows)
    stats = {r["id"]: r["total_reviews"] for r in q(spark, sf_dir, "execution_stats").collect()}
    assert all(stats[r["id"]] == r["actual_reviews"] for r in rows)


def test_2_2_no_duplicate_place_ids(spark, sf_dir):
    b = W.businesses(spark, sf_dir)
    assert Q.unique_violations(b, ["apify_place_id"]).count() == 0


def test_2_4_and_2_5_documents_have_required_keys_and_populated_columns(spark, sf_dir):
    rep = dq(spark, sf_dir)
    assert rep["missing_required_keys"] == 0
    assert rep["populated_rating"] == rep["businesses"]
    assert 0 < rep["populated_city"] < rep["businesses"]      # every 50th business has no city


def test_2_x_defensive_extraction_flags(spark, sf_dir):
    rep = dq(spark, sf_dir)
    assert rep["bad_stars"] > 0 and rep["bad_date"] > 0 and rep["stars_out_of_range"] > 0


# 3 chat ------------------------------------------------------------------------------
def test_3_1_to_3_3_simple_aggregate_and_session(spark, sf_dir):
    assert q(spark, sf_dir, "biz_by_city").count() == 10
    assert q(spark, sf_dir, "category_analysis").count() > 0
    mem = q(spark, sf_dir, "session_memory")
    assert mem.groupBy("conv_id").count().agg(F.max("count")).first()[0] <= 10


def test_3_5_json_key_query(spark, sf_dir):
    rows = q(spark, sf_dir, "biz_with_instagram").collect()
    assert rows and all(r["instagram"] for r in rows)


# 4 tools -----------------------------------------------------------------------------
def test_4_1_and_4_5_rating_filters(spark, sf_dir):
    assert all(float(r["rating"]) > 4.5 and r["review_count"] < 30
               for r in q(spark, sf_dir, "high_rated_low_reviews").collect())


def test_4_4_sentiment_buckets_cover_all_reviews(spark, sf_dir):
    total = sum(r["review_count"] for r in q(spark, sf_dir, "sentiment_buckets").collect())
    assert total == W.reviews(spark, sf_dir).count()


def test_4_7_city_category_having(spark, sf_dir):
    assert all(r["business_count"] > 3 for r in q(spark, sf_dir, "category_city_stats").collect())


# 5 errors ----------------------------------------------------------------------------
def test_5_1_unknown_column_is_an_analysis_error(spark, sf_dir):
    with pytest.raises(AnalysisException):
        W.businesses(spark, sf_dir).select("no_such_column").collect()


def test_5_2_and_5_4_not_null_rules(spark):
    df = spark.createDataFrame([(1, "a", "{}", 1), (2, None, "{}", 1), (3, "c", None, 1), (4, "d", "{}", None)],
                               "id long, business_name string, business_data string, execution_id int")
    assert sorted(r["id"] for r in Q.validate_not_null(df).collect()) == [2, 3, 4]


def test_5_3_duplicate_key_detected(spark):
    df = spark.createDataFrame([("p1",), ("p1",), ("p2",)], "apify_place_id string")
    assert Q.unique_violations(df, ["apify_place_id"]).first()["occurrences"] == 2


# 6 performance (plan shape, not milliseconds) ------------------------------------------
def test_6_1_city_filter_pushed_to_stored_scan(spark, sf_dir):
    df = q(spark, sf_dir, "city_rating_filter")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(city), EqualTo(city,METRO)" in plan.replace("\n", " ") or \
        "EqualTo(city,METRO)" in plan


def test_6_5_aggregates_are_partial_before_shuffle(spark, sf_dir):
    df = q(spark, sf_dir, "niche_swot_analysis")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan or "partial_count" in plan


# 7 end to end ------------------------------------------------------------------------
def test_7_1_run_review_rows_per_run(spark, sf_dir):
    assert q(spark, sf_dir, "run_review_rows").agg(F.sum("review_rows")).first()[0] == \
        W.reviews(spark, sf_dir).count()


def test_7_4_worst_shop_drilldown(spark, sf_dir):
    rows = q(spark, sf_dir, "worst_shop_complaints").collect()
    worst = q(spark, sf_dir, "worst_shop").first()
    assert rows and all(r["business_name"] == worst["business_name"] and r["stars"] <= 3 for r in rows)


def test_7_5_success_factors_chain(spark, sf_dir):
    rows = q(spark, sf_dir, "success_factors").collect()
    assert rows and all(r["positive_review_count"] > 0 for r in rows)


def test_derived_fixture_matches_warehouse(spark, sf_dir):
    a = fx.businesses(spark, sf_dir)
    b = W.businesses(spark, sf_dir)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
