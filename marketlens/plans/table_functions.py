"""The parametrised queries as SQL table functions over the registered tables.

``register_functions`` makes ``SELECT * FROM biz_by_city('METRO')`` and the
like run in ``spark.sql``.  A call is planned as the query it stands for:
filters on its arguments reach the scan, and reviews are summed per business
before they meet other tables.  Rows come in no order of their own; a caller
adds ``ORDER BY … LIMIT n`` (planned as a top-n, unlike a number of rows
given as an argument).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

INSTAGRAM = "try_variant_get(business_doc, '$.social.instagrams', 'string')"
HAS_INSTAGRAM = "(try_variant_get(business_doc, '$.social.instagrams', 'variant') IS NOT NULL)"

#: name: (parameters with defaults, returned columns, query)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "biz_by_city": ("in_city STRING DEFAULT 'METRO'", "id BIGINT, business_name STRING, category STRING, rating DECIMAL(3,1), review_count INT",
                    "SELECT id, business_name, category, rating, review_count FROM businesses WHERE city = biz_by_city.in_city"),
    "high_rated_low_reviews": ("min_rating DOUBLE DEFAULT 4.5, max_reviews INT DEFAULT 30", "business_name STRING, city STRING, rating DECIMAL(3,1), review_count INT",
                               "SELECT business_name, city, rating, review_count FROM businesses WHERE rating > min_rating AND review_count < max_reviews"),
    "biz_with_instagram": ("", "business_name STRING, city STRING, instagram STRING",
                           f"SELECT business_name, city, {INSTAGRAM} FROM businesses WHERE {HAS_INSTAGRAM} AND {INSTAGRAM} != ''"),
    "category_analysis": ("in_city STRING DEFAULT 'METRO', min_n INT DEFAULT 3", "category STRING, count BIGINT, avg_rating DOUBLE, total_reviews BIGINT",
                          """SELECT category, n, mean, total FROM (SELECT category, count(*) AS n, round(avg(rating), 2) AS mean, sum(review_count) AS total
                             FROM businesses WHERE city = category_analysis.in_city GROUP BY category) WHERE n > min_n"""),
    "category_city_stats": ("min_n INT DEFAULT 3", "city STRING, category STRING, business_count BIGINT, avg_rating DOUBLE, total_reviews BIGINT",
                            """SELECT city, category, n, mean, total FROM (SELECT city, category, count(*) AS n, sum(CAST(rating * 10 AS BIGINT)) / (10D * count(rating)) AS mean, sum(review_count) AS total
                               FROM businesses WHERE city IS NOT NULL GROUP BY city, category) WHERE n > min_n"""),
    "influencer_potential": ("max_reviews INT DEFAULT 50", "business_name STRING, city STRING, rating DECIMAL(3,1), review_count INT, instagram STRING",
                             f"SELECT business_name, city, rating, review_count, {INSTAGRAM} FROM businesses WHERE {INSTAGRAM} IS NOT NULL AND review_count < max_reviews"),
    "social_gap": ("min_rating DOUBLE DEFAULT 4.5, min_reviews INT DEFAULT 50", "id BIGINT, business_name STRING, city STRING, rating DECIMAL(3,1), review_count INT, has_instagram STRING",
                   f"""SELECT id, business_name, city, rating, review_count, CASE WHEN {HAS_INSTAGRAM} THEN 'Yes' ELSE 'No' END FROM businesses
                       WHERE rating > min_rating AND review_count > min_reviews AND ({INSTAGRAM} IS NULL OR {INSTAGRAM} = '')"""),
    "city_rating_filter": ("in_city STRING DEFAULT 'METRO', min_rating DOUBLE DEFAULT 4.0", "business_name STRING, rating DECIMAL(3,1), review_count INT",
                           "SELECT business_name, rating, review_count FROM businesses WHERE city = city_rating_filter.in_city AND rating >= min_rating"),
    "name_prefix_search": ("prefix STRING", "id BIGINT, business_name STRING, city STRING",
                           "SELECT id, business_name, city FROM businesses WHERE startswith(lower(business_name), lower(prefix))"),
    "review_keyword_search": ("keyword STRING", "business_name STRING, review_text STRING, stars INT",
                              """SELECT b.business_name, r.review_text, r.stars FROM business_reviews r JOIN businesses b ON b.id = r.business_id
                                 WHERE contains(lower(r.review_text), lower(keyword))"""),
    "reviews_of_business": ("name_like STRING, max_stars INT DEFAULT 2", "reviewer_name STRING, stars INT, review_text STRING, published_at DATE",
                            """SELECT reviewer_name, stars, review_text, published_at FROM business_reviews r
                               JOIN (SELECT CASE WHEN count(*) > 1 THEN CAST(raise_error('more than one business has that name') AS BIGINT) ELSE max(id) END AS one
                                     FROM businesses WHERE contains(lower(business_name), lower(name_like))) ON one = r.business_id WHERE stars <= max_stars"""),
    "sentiment_by_category": ("in_city STRING DEFAULT 'METRO'", "category STRING, avg_stars DOUBLE, review_count BIGINT, negative_reviews BIGINT",
                              """SELECT category, sum(total) / sum(rated), sum(n), sum(bad) FROM (
                                   SELECT business_id, sum(stars) AS total, count(stars) AS rated, count(*) AS n, count_if(stars <= 2) AS bad FROM business_reviews GROUP BY business_id) r
                                 JOIN businesses b ON b.id = r.business_id WHERE city = sentiment_by_category.in_city GROUP BY category"""),
    "executions_since": ("day TIMESTAMP_NTZ", "id BIGINT, created_at TIMESTAMP_NTZ, status STRING, search_query STRING",
                         "SELECT id, created_at, status, search_query FROM market_executions WHERE created_at > day"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions over the views of :func:`marketlens.plans.catalog.register_market`; returns their names."""
    for name, (parameters, columns, query) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {query}")
    return list(FUNCTIONS)
