"""Property tests: plan rewrites equal the reference's literal shape on random data."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions import themes as TH
from marketlens.plans import views as V
from marketlens.sources import store as S

TEXTS = ["fast and professional", "rude and slow", "excellent quality, fair price", "overpriced, broken part",
         "never showed, missed appointment", "quick and timely", "average", None]
B = T.StructType([T.StructField("id", T.LongType()), T.StructField("business_name", T.StringType()),
                  T.StructField("category", T.StringType()), T.StructField("city", T.StringType()),
                  T.StructField("rating", T.DecimalType(3, 1))])
R = T.StructType([T.StructField("id", T.LongType()), T.StructField("business_id", T.LongType()),
                  T.StructField("stars", T.IntegerType()), T.StructField("review_text", T.StringType()),
                  T.StructField("published_at", T.DateType())])

biz_rows = st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from(["X", "Y", None])),
                    min_size=1, max_size=6)
rev_rows = st.lists(st.tuples(st.integers(0, 5), st.sampled_from([None, 1, 2, 3, 4, 5]),
                              st.sampled_from(TEXTS)), min_size=0, max_size=60)


def _frames(spark, bs, rs):
    b = spark.createDataFrame([(i, f"b{i}", c, t, Decimal("4.0")) for i, (c, t) in enumerate(bs)], B)
    r = spark.createDataFrame([(j, k % len(bs), s, txt, dt.date(2025, 9, 1)) for j, (k, s, txt) in enumerate(rs)], R)
    return b, r


def _two_pass_swot(b, r):
    """The reference's SQL shape: two grouped halves, FULL JOIN USING (category, city)."""
    j = r.join(b.withColumnRenamed("id", "business_id"), "business_id")
    text = F.col("review_text")
    p = j.filter(F.col("stars") >= 4).groupBy("category", "city").agg(
        *[F.count(F.when(TH.has_words(text, TH.STRENGTH_THEMES[k]), 1)).alias(f"p_{k}")
          for k in ("professionalism", "speed", "pricing", "quality")],
        F.count(F.lit(1)).alias("total_positive_reviews"))
    n = j.filter(F.col("stars") <= 3).groupBy("category", "city").agg(
        F.count(F.lit(1)).alias("total_negative_reviews"))
    full = p.join(n, ["category", "city"], "full")      # USING: NULL keys never match
    full = full.filter(F.coalesce("total_positive_reviews", F.lit(0))
                       + F.coalesce("total_negative_reviews", F.lit(0)) >= 15)
    return full.select("category", "city", F.col("total_positive_reviews").cast("bigint").alias("tp"),
                       F.col("total_negative_reviews").cast("bigint").alias("tn"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(bs=biz_rows, rs=rev_rows)
def test_single_pass_swot_equals_two_pass(spark, bs, rs):
    b, r = _frames(spark, bs, rs)
    one = V.niche_swot_analysis(b, r, ordered=False).select(
        "category", "city", F.col("total_positive_reviews").alias("tp"), F.col("total_negative_reviews").alias("tn"))
    two = _two_pass_swot(b, r)
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(bs=biz_rows, rs=rev_rows)
def test_pain_points_equal_review_grain_plan(spark, bs, rs):
    b, r = _frames(spark, bs, rs)
    one = V.customer_pain_points(b, r, ordered=False).select("category", "city", "total_complaints", "pricing_complaints")
    j = r.filter((F.col("stars") <= 2) & F.col("review_text").isNotNull()) \
         .join(b.withColumnRenamed("id", "business_id"), "business_id")
    two = j.groupBy("category", "city").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_complaints"),
        F.sum(TH.flag(TH.has_words(F.col("review_text"), TH.PAIN_THEMES["pricing"]))).cast("bigint")
        .alias("pricing_complaints")).filter("total_complaints >= 3")
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
    kept = {(x["category"], x["city"]) for x in one.collect()}
    texts = j.filter("stars = 1").groupBy("category", "city", F.substring("review_text", 1, 100).alias("snippet")).agg(
        F.count(F.lit(1)).alias("mentions")).collect()
    got = V.complaint_snippets(b, r).select("category", "city", "snippet", "mentions").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((tuple(x) for x in texts if (x["category"], x["city"]) in kept), key=repr)


def test_upsert_is_idempotent(spark):
    now = dt.datetime(2025, 10, 1, 6)
    old = spark.createDataFrame([(1, "k1", 10, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1))],
                                "id long, key string, n int, created_at timestamp_ntz, updated_at timestamp_ntz")
    inc = spark.createDataFrame([("k1", 11, dt.datetime(2025, 9, 1)), ("k2", 5, dt.datetime(2025, 9, 1))],
                                "key string, n int, scraped_at timestamp_ntz")
    once = S.upsert(old, inc, "key", now)
    twice = S.upsert(once, inc, "key", now)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
