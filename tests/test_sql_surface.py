"""Views, filters, aggregates, JSON keys and text search through spark.sql on temp views."""

import pytest
from pyspark.errors import AnalysisException

from marketlens.functions import jsonops as J
from marketlens.operators import search as S
from marketlens.plans.catalog import register_market, view_inventory
from marketlens.plans.registry import all_queries
from marketlens.plans.table_functions import FUNCTIONS
from marketlens.sources import warehouse as W


@pytest.fixture(scope="module")
def market(spark, sf_dir):
    register_market(spark, sf_dir)
    return spark


def test_all_views_registered(market):
    assert all(ok for _, ok in view_inventory(market))


def test_view_row_counts_union_all(market):
    rows = market.sql("""
        SELECT 'niche_opportunities' AS view, count(*) AS n FROM niche_opportunities
        UNION ALL SELECT 'market_leaders', count(*) FROM market_leaders
        UNION ALL SELECT 'vulnerable_players', count(*) FROM vulnerable_players""").collect()
    assert len(rows) == 3 and all(r["n"] > 0 for r in rows)


def test_filters_aggregates_and_json_through_sql(market, sf_dir):
    S.register_sql(market, W.review_postings(market, sf_dir))
    J.register_sql(market)
    assert market.sql("SELECT * FROM niche_opportunities WHERE opportunity_score >= 8").count() > 0
    few = market.sql("SELECT rating, review_count FROM businesses WHERE rating > 4.5 AND review_count < 30 ORDER BY rating DESC").collect()
    assert few and all(r["rating"] > 4.5 and r["review_count"] < 30 for r in few)
    mood = market.sql("""SELECT category, mean(stars) AS mood, count_if(stars < 3) AS sour
                         FROM businesses JOIN business_reviews ON business_reviews.business_id = businesses.id
                         WHERE city = 'METRO' GROUP BY category""").collect()
    assert len(mood) == 5 and all(1 <= r["mood"] <= 5 and r["sour"] > 0 for r in mood)
    assert market.sql("SELECT id FROM businesses WHERE json_has_key(business_data, '$.social', 'instagrams')").count() > 0
    assert market.sql("SELECT r.id FROM business_reviews r JOIN texts_with_phrase('missed', 'appointments') USING (id)").count() > 0


def test_scalar_subquery_and_errors(market):
    one = market.sql("""SELECT count(*) AS n FROM business_reviews WHERE business_id =
                        (SELECT id FROM businesses WHERE business_name ILIKE '%Customer#000000001%')""").first()
    assert one["n"] > 0
    with pytest.raises(Exception):
        market.sql("""SELECT count(*) FROM business_reviews WHERE business_id =
                      (SELECT id FROM businesses WHERE business_name ILIKE '%Customer#00000001%')""").collect()
    with pytest.raises(AnalysisException):
        market.sql("SELECT no_such_column FROM businesses").collect()   # test 5.1


#: Calls that must equal a registered key: its rows, as the key orders and limits them.
CALLS = {
    "biz_by_city": "SELECT business_name, category, rating, review_count FROM biz_by_city('METRO') ORDER BY rating DESC NULLS FIRST, id LIMIT 10",
    "high_rated_low_reviews": "SELECT * FROM high_rated_low_reviews(4.5, 30)",
    "biz_with_instagram": "SELECT * FROM biz_with_instagram()",
    "category_analysis": "SELECT * FROM category_analysis('METRO')",
    "category_city_stats": "SELECT * FROM category_city_stats()",
    "influencer_potential": "SELECT * FROM influencer_potential()",
    "social_gap": "SELECT * EXCEPT (id) FROM (SELECT * FROM social_gap() ORDER BY review_count DESC NULLS FIRST, id LIMIT 20)",
    "city_rating_filter": "SELECT * FROM city_rating_filter(min_rating => 4.0)",
    "name_prefix_search": "SELECT * FROM name_prefix_search('customer#00000001')",
    "review_keyword_search": "SELECT * FROM review_keyword_search('Parking')",
    "reviews_of_business": "SELECT * FROM reviews_of_business('customer#000000001')",
    "sentiment_by_category": "SELECT * FROM sentiment_by_category()",
    "executions_last_7d": "SELECT * FROM executions_since(TIMESTAMP_NTZ '{now}' - INTERVAL 7 DAYS)",
}


@pytest.mark.parametrize("key", CALLS)
def test_table_functions_equal_their_keys(market, sf_dir, key):
    from marketlens.plans.queries import DEFAULT_NOW
    got = market.sql(CALLS[key].format(now=DEFAULT_NOW.isoformat(sep=" ")))
    want = all_queries()[key](market, sf_dir)
    assert got.columns == want.columns
    rows = lambda df: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)
    assert rows(got) == rows(want) and want.count() > 0


def test_arguments_reach_the_scan(market):
    plan = market.sql("SELECT * FROM city_rating_filter('METRO', 4.2)")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(city,METRO)" in plan
    assert len(FUNCTIONS) == len(CALLS)


def test_an_ambiguous_name_is_an_error(market):
    with pytest.raises(Exception):
        market.sql("SELECT * FROM reviews_of_business('Customer#00000001')").collect()
