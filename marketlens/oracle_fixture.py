"""The derived market tables written as DuckDB SQL CTEs.

Independent re-statement of ``marketlens.sources.fixture`` for the SQL
oracle: ``with_market("SELECT ...")`` prefixes a query with CTEs named
``businesses``, ``business_reviews``, ``market_executions`` and
``raw_reviews`` built from the driver's pre-registered views.
"""

from __future__ import annotations

from marketlens.sources.fixture import REVIEW_TEMPLATES


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_TEMPLATE_LIST = "[" + ", ".join(_sql_str(t) for t in REVIEW_TEMPLATES) + "]"

BUSINESSES_CTE = r"""
businesses AS (
  SELECT b0.*,
    '{"overview":{"title":' || CASE WHEN business_name IS NULL THEN 'null' ELSE '"' || business_name || '"' END
    || ',"category":' || CASE WHEN category IS NULL THEN 'null' ELSE '"' || category || '"' END
    || ',"city":' || CASE WHEN city IS NULL THEN 'null' ELSE '"' || city || '"' END
    || '},"contact":{"phone":' || CASE WHEN phone IS NULL THEN 'null' ELSE '"' || phone || '"' END
    || ',"website":' || CASE WHEN website IS NULL THEN 'null' ELSE '"' || website || '"' END
    || '},"social":{"instagrams":'
    || CASE WHEN id % 3 = 0 THEN '"https://instagram.com/b' || CAST(id AS VARCHAR) || '"'
            WHEN id % 3 = 1 THEN '""' ELSE 'null' END
    || CASE WHEN id % 4 = 0 THEN ',"facebookPages":"https://facebook.com/b' || CAST(id AS VARCHAR) || '"' ELSE '' END
    || '},"rating":{"totalScore":"' || CAST(rating AS VARCHAR)
    || '","reviewsCount":' || COALESCE(CAST(review_count AS VARCHAR), 'null')
    || CASE WHEN id % 10 = 9 THEN '' ELSE
         ',"reviewsDistribution":{"oneStar":' || CAST(id % 7 AS VARCHAR)
         || ',"twoStar":' || CAST(id % 5 AS VARCHAR)
         || ',"threeStar":' || CAST(id % 11 AS VARCHAR)
         || ',"fourStar":' || CAST(id % 13 AS VARCHAR)
         || ',"fiveStar":' || CAST(id % 17 AS VARCHAR) || '}' END
    || '},"tags":' || CASE WHEN tag IS NULL THEN '[]' ELSE '["' || tag || '"]' END
    || '}' AS business_data
  FROM (
    SELECT
      c.c_custkey AS id,
      CAST(c.c_nationkey AS INTEGER) AS execution_id,
      c.c_name AS business_name,
      'https://maps.example.com/?cid=' || CAST(c.c_custkey AS VARCHAR) AS apify_place_id,
      c.c_mktsegment AS category,
      CASE WHEN c.c_custkey % 50 = 49 THEN NULL
           WHEN c.c_custkey % 2 = 0 THEN 'METRO'
           WHEN c.c_custkey % 3 = 0 THEN r.r_name
           ELSE n.n_name END AS city,
      CAST(1.0 + (c.c_custkey % 41) / 10.0 AS DECIMAL(3,1)) AS rating,
      CASE WHEN c.c_custkey % 29 = 0 THEN NULL ELSE CAST((c.c_custkey * 37) % 400 AS INTEGER) END AS review_count,
      CASE WHEN c.c_custkey % 5 = 0 THEN NULL
           WHEN c.c_custkey % 5 = 1 THEN ''
           ELSE 'https://b' || CAST(c.c_custkey AS VARCHAR) || '.example.com' END AS website,
      CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE '+1-555-' || CAST(c.c_custkey AS VARCHAR) END AS phone,
      CASE WHEN c.c_custkey % 60 = 0 THEN 'Emergency Service'
           WHEN c.c_custkey % 60 = 2 THEN '24/7 Access'
           WHEN c.c_custkey % 60 = 3 THEN 'Installation'
           WHEN c.c_custkey % 300 = 10 THEN 'Custom Design'
           WHEN c.c_custkey % 20 = 4 THEN 'AC Repair' END AS tag,
      TIMESTAMP '2025-09-01 00:00:00' + to_minutes(CAST(c.c_custkey AS BIGINT)) AS created_at
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
  ) b0
)"""

REVIEWS_CTE = r"""
business_reviews AS (
  SELECT id, business_id, reviewer_name,
    CASE WHEN id % 23 = 0 THEN NULL ELSE CAST(s + 1 AS INTEGER) END AS stars,
    CASE WHEN id % 31 = 0 THEN NULL ELSE
      (__TEMPLATES__)[CAST(CASE WHEN s <= 1 THEN (id + 5 * business_id) % 7
                                WHEN s = 2 THEN 7 + id % 2
                                ELSE 9 + (id + 5 * business_id) % 6 END AS INTEGER) + 1] END AS review_text,
    CAST(DATE '2025-10-01' - CAST((id * 7919) % 540 AS INTEGER) AS DATE) AS published_at
  FROM (
    SELECT o_orderkey AS id, o_custkey AS business_id,
      'user_' || CAST(o_orderkey % 997 AS VARCHAR) AS reviewer_name,
      (o_orderkey * 7 + o_custkey * 3) % 5 AS s
    FROM orders
  ) r0
)""".replace("__TEMPLATES__", _TEMPLATE_LIST)

EXECUTIONS_CTE = r"""
market_executions AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id,
    TIMESTAMP '2025-09-01 00:00:00' + to_days(CAST(n_nationkey AS INTEGER)) AS created_at,
    CASE WHEN n_nationkey % 6 = 5 THEN NULL
         ELSE TIMESTAMP '2025-09-01 00:00:00' + to_days(CAST(n_nationkey AS INTEGER))
              + to_minutes(CAST((7 * n_nationkey) % 60 + 1 AS BIGINT)) END AS completed_at,
    CASE WHEN n_nationkey % 6 = 5 THEN 'running'
         WHEN n_nationkey % 6 = 4 THEN 'failed' ELSE 'completed' END AS status,
    'query_' || CAST(n_nationkey % 5 AS VARCHAR) AS search_query
  FROM nation
)"""

RAW_REVIEWS_CTE = r"""
raw_reviews AS (
  SELECT id, business_id,
    '{"reviewId":"r' || CAST(id AS VARCHAR) || '","reviewerName":'
    || CASE WHEN reviewer_name IS NULL THEN 'null' ELSE '"' || reviewer_name || '"' END
    || ',"stars":' || CASE WHEN id % 37 = 0 THEN '"five"' WHEN id % 41 = 0 THEN '99'
                           WHEN id % 43 = 0 THEN '"4.5"' ELSE COALESCE(CAST(stars AS VARCHAR), 'null') END
    || ',"text":' || CASE WHEN review_text IS NULL THEN 'null' ELSE '"' || review_text || '"' END
    || ',"publishedAtDate":' || CASE WHEN id % 47 = 0 THEN '"not-a-date"'
                                     ELSE '"' || CAST(published_at AS VARCHAR) || 'T12:00:00.000Z"' END
    || '}' AS review_data
  FROM business_reviews
)"""

ALL_CTES = ",".join([BUSINESSES_CTE, REVIEWS_CTE, EXECUTIONS_CTE, RAW_REVIEWS_CTE])


def with_market(body: str) -> str:
    """Prefix ``body`` (a SELECT, optionally starting with more CTEs via
    ``, name AS (...)``) with the market-table CTEs."""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ALL_CTES + ",\n" + body[5:]
    return "WITH " + ALL_CTES + "\n" + body
