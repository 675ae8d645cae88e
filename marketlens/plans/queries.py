"""Parametrised business / review / run queries (the ad-hoc patterns).

Each function takes DataFrames plus parameters and returns a lazy
DataFrame.  Top-k functions break ties on the primary key so LIMIT is
deterministic; everything else returns whole results.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import themes as T
from marketlens.functions.jsonops import document, has_key_at, text_at
from marketlens.functions.scalar import avg_exact, dround, ntz_lit, safe_div
from marketlens.operators.distinct_rollup import bitmaps, merged
from marketlens.operators.joined_text import joined_pieces, joined_texts
from marketlens.plans import views as V
from marketlens.session import materialize
from marketlens.sources.fixture import AS_OF

DEFAULT_CITY = "METRO"
DEFAULT_CATEGORY = "BUILDING"
DEFAULT_NOW = _dt.datetime(2025, 9, 25, 0, 0, 0)


def _ig(b: DataFrame) -> Column:
    return text_at(document(b), "social", "instagrams")


def scope_reviews(reviews: DataFrame, businesses: DataFrame) -> DataFrame:
    """Reviews of the given businesses only (semi-join, before aggregation)."""
    return reviews.join(businesses.select(F.col("id").alias("business_id")), "business_id", "left_semi")


# ---------------------------------------------------------------------------
# business queries
# ---------------------------------------------------------------------------
def biz_by_city(b: DataFrame, city: str = DEFAULT_CITY, n: int = 10) -> DataFrame:
    """Q1: top-n businesses of a city by rating."""
    return (b.filter(F.col("city") == city)
            .orderBy(F.desc_nulls_first("rating"), "id").limit(n)
            .select("business_name", "category", "rating", "review_count"))


def high_rated_low_reviews(b: DataFrame, min_rating: float = 4.5, max_reviews: int = 30) -> DataFrame:
    """Q2: rating > min and review_count < max."""
    return (b.filter((F.col("rating") > min_rating) & (F.col("review_count") < max_reviews))
            .select("business_name", "city", "rating", "review_count")
            .orderBy(F.desc_nulls_first("rating")))


def biz_with_instagram(b: DataFrame) -> DataFrame:
    """Q3: social has key 'instagrams' and a non-empty value."""
    return (b.filter(has_key_at(document(b), "instagrams", "social") & (_ig(b) != ""))
            .select("business_name", "city", _ig(b).alias("instagram")))


def category_analysis(b: DataFrame, city: str = DEFAULT_CITY, min_n: int = 3) -> DataFrame:
    """Q4: per-category counts in one city, HAVING count > min_n."""
    return (b.filter(F.col("city") == city).groupBy("category")
            .agg(F.count(F.lit(1)).alias("count"), dround(F.avg("rating"), 2).alias("avg_rating"),
                 F.sum("review_count").cast("bigint").alias("total_reviews"))
            .filter(F.col("count") > min_n)
            .orderBy(F.desc_nulls_first("total_reviews")))


def category_city_stats(b: DataFrame, min_n: int = 3) -> DataFrame:
    """Q5: city × category rollup, HAVING count > min_n."""
    return (b.filter(F.col("city").isNotNull()).groupBy("city", "category")
            .agg(F.count(F.lit(1)).alias("business_count"),
                 avg_exact(F.col("rating")).alias("avg_rating"),
                 F.sum("review_count").cast("bigint").alias("total_reviews"))
            .filter(F.col("business_count") > min_n)
            .orderBy(F.desc_nulls_first("total_reviews")))


def influencer_potential(b: DataFrame, max_reviews: int = 50) -> DataFrame:
    """Q6: Instagram present and few reviews."""
    return (b.filter(_ig(b).isNotNull() & (F.col("review_count") < max_reviews))
            .select("business_name", "city", "rating", "review_count", _ig(b).alias("instagram"))
            .orderBy(F.desc_nulls_first("rating")))


def social_gap(b: DataFrame, min_rating: float = 4.5, min_reviews: int = 50, n: int = 20) -> DataFrame:
    """Q12: good businesses without an Instagram value, top n by review_count."""
    ig = _ig(b)
    return (b.filter((F.col("rating") > min_rating) & (F.col("review_count") > min_reviews)
                     & (ig.isNull() | (ig == "")))
            .orderBy(F.desc_nulls_first("review_count"), "id").limit(n)
            .select("business_name", "city", "rating", "review_count",
                    F.when(has_key_at(document(b), "instagrams", "social"), "Yes")
                    .otherwise("No").alias("has_instagram")))


def city_rating_filter(b: DataFrame, city: str = DEFAULT_CITY, min_rating: float = 4.0) -> DataFrame:
    """Q14: one city, rating at least min, best first."""
    return (b.filter((F.col("city") == city) & (F.col("rating") >= min_rating))
            .select("business_name", "rating", "review_count")
            .orderBy(F.desc_nulls_first("rating"), F.desc_nulls_first("review_count")))


def city_stats(b: DataFrame) -> DataFrame:
    """Q20: per-city rollup."""
    return (b.groupBy("city").agg(F.count(F.lit(1)).alias("businesses"),
                                  avg_exact(F.col("rating")).alias("avg_rating"),
                                  F.sum("review_count").cast("bigint").alias("total_reviews"))
            .orderBy(F.desc_nulls_first("total_reviews")))


def rating_buckets(b: DataFrame) -> DataFrame:
    """Q21: rating bucket distribution ordered by the bucket's MIN(rating)."""
    r = F.col("rating")
    bucket = (F.when(r >= 4.5, "Excellent (4.5+)").when(r >= 4.0, "Good (4.0-4.4)")
              .when(r >= 3.0, "Average (3.0-3.9)").otherwise("Poor (<3.0)"))
    return (b.groupBy(bucket.alias("rating_category"))
            .agg(F.count(F.lit(1)).alias("business_count"), F.min("rating").alias("_min"))
            .orderBy(F.desc_nulls_first("_min")).drop("_min"))


def name_prefix_search(b: DataFrame, prefix: str = "customer#00000001") -> DataFrame:
    """Case-insensitive name prefix lookup (lower(name) index pattern)."""
    return b.filter(F.lower("business_name").startswith(prefix.lower())).select("id", "business_name", "city")


def null_execution_probe(b: DataFrame) -> DataFrame:
    """Rows violating NOT NULL on execution_id / business_data / name."""
    return b.filter(F.col("execution_id").isNull() | F.col("business_data").isNull()
                    | F.col("business_name").isNull()).select("id")


def busy_categories(b: DataFrame, min_n: int = 50) -> DataFrame:
    """Categories with more than min_n businesses (HAVING)."""
    return (b.groupBy("category").agg(F.count(F.lit(1)).alias("business_count"))
            .filter(F.col("business_count") > min_n))


def market_gap_labels(b: DataFrame, min_rating: float = 4.5, max_reviews: int = 50) -> DataFrame:
    """Constant label projection on an underserved filter."""
    return (b.filter((F.col("rating") > min_rating) & (F.col("review_count") < max_reviews))
            .select("business_name", "rating", "review_count", F.lit("Market gap").alias("opportunity")))


def first_businesses(b: DataFrame, n: int = 5) -> DataFrame:
    """LIMIT n in key order."""
    return b.orderBy("id").limit(n).select("id", "business_name")


def top_categories(b: DataFrame, n: int = 5) -> DataFrame:
    """Categories ranked by business count, top n."""
    return (b.groupBy("category").agg(F.count(F.lit(1)).alias("business_count"),
                                      dround(F.avg("rating"), 2).alias("avg_rating"))
            .orderBy(F.desc("business_count"), "category").limit(n))


# ---------------------------------------------------------------------------
# review queries
# ---------------------------------------------------------------------------
def reviews_with_business(b: DataFrame, r: DataFrame) -> DataFrame:
    """Review-grain inner join (AQE splits a skewed business key)."""
    return r.join(b.select(F.col("id").alias("business_id"), "business_name", "category", "city"),
                  "business_id").select("id", "business_id", "business_name", "category", "city",
                                        "stars", "published_at")


def review_keyword_search(b: DataFrame, r: DataFrame, kw: str = "parking") -> DataFrame:
    """Q7: ILIKE keyword with business context, best stars first."""
    hits = r.filter(F.col("review_text").ilike(f"%{kw}%")).select("business_id", "review_text", "stars")
    return (hits.join(b.select(F.col("id").alias("business_id"), "business_name"), "business_id")
            .select("business_name", "review_text", "stars").orderBy(F.desc_nulls_first("stars")))


def reviews_of_business(b: DataFrame, r: DataFrame, name_like: str = "Customer#000000001",
                        max_stars: int = 2) -> DataFrame:
    """Negative reviews of the one business whose name matches.

    ``scalar()`` is a real scalar subquery: more than one match raises,
    exactly like the reference's ``= (SELECT id ...)``.
    """
    bid = b.filter(F.col("business_name").ilike(f"%{name_like}%")).select("id").scalar()
    return (r.filter((F.col("business_id") == bid) & (F.col("stars") <= max_stars))
            .select("reviewer_name", "stars", "review_text", "published_at")
            .orderBy(F.desc_nulls_first("published_at")))


def sentiment_by_category(b: DataFrame, r: DataFrame, city: str = DEFAULT_CITY) -> DataFrame:
    """Q10: avg stars, review count and negatives per category of one city."""
    bc = b.filter(F.col("city") == city)
    # pre-aggregate every review per business (map-side combine), then join the
    # city's businesses: a review-grain semi-join would shuffle raw reviews
    per = r.groupBy("business_id").agg(
        F.sum("stars").alias("_ss"), F.count("stars").alias("_sn"), F.count("id").alias("_n"),
        F.count(F.when(F.col("stars") <= 2, 1)).alias("_neg"))
    j = per.join(bc.select(F.col("id").alias("business_id"), "category"), "business_id")
    return (j.groupBy("category").agg(
        safe_div(F.sum("_ss"), F.sum("_sn")).alias("avg_stars"),
        F.sum("_n").cast("bigint").alias("review_count"),
        F.sum("_neg").cast("bigint").alias("negative_reviews"))
        .orderBy(F.desc_nulls_first("negative_reviews")))


def sentiment_buckets(r: DataFrame) -> DataFrame:
    """Positive (≥4) / neutral (=3) / negative (else, incl. NULL)."""
    s = F.col("stars")
    bucket = F.when(s >= 4, "positive").when(s == 3, "neutral").otherwise("negative")
    return r.groupBy(bucket.alias("sentiment")).agg(F.count(F.lit(1)).alias("review_count"))


def _keyword_complaints(r: DataFrame, kw: str) -> DataFrame:
    return r.filter((F.col("stars") <= 2) & F.col("review_text").ilike(f"%{kw}%"))


def complaint_themes(b: DataFrame, r: DataFrame, kw: str = "fee", min_n: int = 3) -> DataFrame:
    """Q11: businesses with more than min_n ≤2-star reviews containing kw, their number, and their texts joined in order of ids."""
    hits = _keyword_complaints(r, kw).select("id", "business_id", "review_text")
    named = hits.join(b.select(F.col("id").alias("business_id"), "business_name"), "business_id")
    counts = (hits.groupBy("business_id").agg(F.count(F.lit(1)).alias("m")).join(b.select(F.col("id").alias("business_id"), "business_name"), "business_id")
              .groupBy("business_name").agg(F.sum("m").cast("bigint").alias("complaint_count")).filter(F.col("complaint_count") > min_n))
    pieces = joined_pieces(named, ["business_name"], "review_text", ["id"], " | ")
    return counts.join(joined_texts(pieces, ["business_name"], "sample_complaints"), "business_name")


def complaint_theme_rows(b: DataFrame, r: DataFrame, kw: str = "fee", min_n: int = 3) -> DataFrame:
    """Q11 with its texts as rows: businesses with more than min_n ≤2-star reviews containing kw, and those texts as rows.

    Matching reviews are counted per (business, text) first; a business's
    total is a second sum, so texts are never gathered in one cell.
    """
    hits = _keyword_complaints(r, kw)
    pairs = hits.groupBy("business_id", "review_text").agg(F.count(F.lit(1)).alias("m"))
    named = (pairs.join(b.select(F.col("id").alias("business_id"), "business_name"), "business_id")
             .groupBy("business_name", F.col("review_text").alias("complaint")).agg(F.sum("m").cast("bigint").alias("mentions")))
    total = named.groupBy("business_name").agg(F.sum("mentions").cast("bigint").alias("complaint_count")).filter(F.col("complaint_count") > min_n)
    return named.join(total, "business_name")


def worst_shop_complaints(b: DataFrame, r: DataFrame, category_like: str = "auto",
                          max_stars: int = 3, n: int = 5) -> DataFrame:
    """Q18: category → worst-rated business → its ≤3-star reviews (top 5)."""
    worst = (b.filter(F.col("category").ilike(f"%{category_like}%"))
             .orderBy(F.asc_nulls_last("rating"), "id").limit(1)
             .select(F.col("id").alias("business_id"), "business_name", "rating"))
    rv = r.filter(F.col("stars") <= max_stars).select("id", "business_id", "stars", "review_text")
    return (worst.join(rv, "business_id").orderBy(F.asc_nulls_last("stars"), "id").limit(n)
            .select("business_name", "rating", "stars", "review_text"))


def worst_shop(b: DataFrame, category_like: str = "auto") -> DataFrame:
    """Worst-1 of a category."""
    return (b.filter(F.col("category").ilike(f"%{category_like}%"))
            .orderBy(F.asc_nulls_last("rating"), "id").limit(1).select("id", "business_name", "rating"))


def _praise(b: DataFrame, r: DataFrame, min_rating: float) -> tuple[DataFrame, DataFrame]:
    """High performers, and positive reviews with their first-match factor tag."""
    hp = b.filter(F.col("rating") > min_rating).select(F.col("id").alias("business_id"), "business_name")
    text = F.col("review_text")
    factor = None
    for f in T.SUCCESS_FACTORS:
        cond = text.ilike(f"%{f}%")
        factor = F.when(cond, f) if factor is None else factor.when(cond, f)
    return hp, r.filter(F.col("stars") >= 4).select("id", "business_id", factor.alias("factor"))


def success_factors(b: DataFrame, r: DataFrame, min_rating: float = 4.7) -> DataFrame:
    """High performers → positive reviews → their number, and their first-match factor tags joined in order of ids."""
    hp, praise = _praise(b, r, min_rating)
    per = praise.groupBy("business_id").agg(F.count(F.lit(1)).alias("m"))
    total = per.join(hp, "business_id").groupBy("business_name").agg(F.sum("m").cast("bigint").alias("positive_review_count"))
    pieces = joined_pieces(praise.filter(F.col("factor").isNotNull()).join(hp, "business_id"), ["business_name"], "factor", ["id"], ", ")
    return total.join(joined_texts(pieces, ["business_name"], "success_factors"), "business_name", "left")


def success_factor_rows(b: DataFrame, r: DataFrame, min_rating: float = 4.7) -> DataFrame:
    """Q19 / X7 with its tags as rows, one for each (business, factor).

    Reviews without a tag count under a NULL factor.  Positive reviews are
    summed per (business, factor) and joined once.
    """
    hp, praise = _praise(b, r, min_rating)
    per = praise.groupBy("business_id", "factor").agg(F.count(F.lit(1)).alias("m"))
    named = per.join(hp, "business_id").groupBy("business_name", "factor").agg(F.sum("m").cast("bigint").alias("mentions"))
    total = named.groupBy("business_name").agg(F.sum("mentions").cast("bigint").alias("positive_review_count"))
    return named.join(total, "business_name")


def orphan_reviews(b: DataFrame, r: DataFrame) -> DataFrame:
    """Reviews whose business does not exist (NOT EXISTS)."""
    return r.join(b.select(F.col("id").alias("business_id")), "business_id", "left_anti").select("id", "business_id")


def businesses_with_reviews(b: DataFrame, r: DataFrame) -> DataFrame:
    """EXISTS (a review) → semi-join."""
    return b.join(r.select(F.col("business_id").alias("id")).distinct(), "id", "left_semi").select("id", "business_name")


def counts_per_parent(b: DataFrame, r: DataFrame) -> DataFrame:
    """Correlated COUNT subquery in SELECT → aggregate + left join."""
    per = r.groupBy("business_id").agg(F.count(F.lit(1)).alias("review_rows"))
    return (b.select("id", "business_name").join(per.withColumnRenamed("business_id", "id"), "id", "left")
            .select("id", "business_name", F.coalesce("review_rows", F.lit(0)).alias("review_rows")))


def rating_dispersion(b: DataFrame, r: DataFrame) -> DataFrame:
    """A4: sample stddev of review stars per category (one-pass moments)."""
    per = r.filter(F.col("stars").isNotNull()).groupBy("business_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("stars").alias("_s1"),
        F.sum(F.col("stars") * F.col("stars")).alias("_s2"))
    j = per.join(b.select(F.col("id").alias("business_id"), "category"), "business_id")
    g = j.groupBy("category").agg(F.sum("_n").alias("n"), F.sum("_s1").alias("s1"), F.sum("_s2").alias("s2"))
    n, s1, s2 = (F.col(c).cast("decimal(38,0)") for c in ("n", "s1", "s2"))
    var = F.when(n > 1, (n * s2 - s1 * s1).cast("double") / (n * (n - 1)).cast("double"))
    return g.select("category", F.col("n").cast("bigint").alias("rated_reviews"),
                    dround(F.sqrt(F.greatest(var, F.lit(0.0))), 4).alias("stars_stddev"))


def topic_complaints_per_business(b: DataFrame, hits: DataFrame) -> DataFrame:
    """Q17: the reviews that a search found, per business."""
    per = hits.groupBy("business_id").agg(F.count("id").alias("_n"), F.sum("stars").alias("_ss"),
                                          F.count("stars").alias("_sn"))
    j = per.join(b.select(F.col("id").alias("business_id"), "business_name", "city", "rating"), "business_id")
    return (j.filter(F.col("_n") > 0)
            .select("business_name", "city", "rating", F.col("_n").alias("parking_complaints"),
                    safe_div(F.col("_ss"), F.col("_sn")).alias("avg_complaint_rating"))
            .orderBy(F.desc("parking_complaints")))


def load_summary(b: DataFrame, r: DataFrame) -> DataFrame:
    """Q22: distinct businesses / cities / categories and review rows.

    Businesses are aggregated once, to bitmaps of their ids by market; cities
    and categories are counted over the markets.
    """
    per = r.groupBy("business_id").agg(F.count("id").alias("_n"))
    j = b.select("id", "city", "category").join(per.withColumnRenamed("business_id", "id"), "id", "left")
    markets = bitmaps(j, ["city", "category"], "id", F.sum("_n").alias("_n"))
    ids = merged(markets, [], F.sum("_n").alias("_n")).agg(F.sum(F.bitmap_count("ids")).alias("businesses_loaded"), F.sum("_n").alias("reviews_loaded"))
    parts = [ids.select(F.lit(name).alias("part"), F.col(name).cast("bigint").alias("value")) for name in ("businesses_loaded", "reviews_loaded")]
    parts += [markets.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("value")).select(F.lit(f"unique_{name}").alias("part"), "value")
              for c, name in (("city", "cities"), ("category", "categories"))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return every.agg(*[F.coalesce(F.max(F.when(F.col("part") == name, F.col("value"))), F.lit(0)).alias(name)
                       for name in ("businesses_loaded", "reviews_loaded", "unique_cities", "unique_categories")])


# ---------------------------------------------------------------------------
# run queries
# ---------------------------------------------------------------------------
def execution_trends(e: DataFrame, b: DataFrame) -> DataFrame:
    """Q13: businesses found per search query and run day."""
    per = b.groupBy("execution_id").agg(F.count("id").alias("_n"),
                                        F.sum((F.col("rating") * 10).cast("long")).alias("_rs10"),
                                        F.count("rating").alias("_rn"))
    j = e.join(per.withColumnRenamed("execution_id", "id"), "id")
    # exact average of the decimal rating: one division of the unscaled integer sum
    return (j.groupBy("search_query", F.to_date("created_at").alias("execution_date"))
            .agg(F.sum("_n").cast("bigint").alias("businesses_found"),
                 safe_div(F.sum("_rs10"), F.sum("_rn") * 10).alias("avg_rating"))
            .orderBy(F.desc("execution_date")))


def executions_last_7d(e: DataFrame, now: _dt.datetime = DEFAULT_NOW) -> DataFrame:
    """Q15: runs created in the 7 days before ``now``."""
    cut = ntz_lit(now) - F.expr("INTERVAL 7 DAYS")
    return e.filter(F.col("created_at") > cut).select("id", "created_at", "status", "search_query")


def latest_runs(e: DataFrame, b: DataFrame, r: DataFrame, n: int = 5) -> DataFrame:
    """Q16: latest n runs."""
    return V.latest_with_totals(e, b, r, n).select("id", "created_at", "search_query", "total_businesses", "total_reviews", "status")


def run_review_rows(e: DataFrame, b: DataFrame, r: DataFrame) -> DataFrame:
    """Run → business → review inner chain, counted per run."""
    per = r.groupBy("business_id").agg(F.count(F.lit(1)).alias("_n"))
    j = per.join(b.select(F.col("id").alias("business_id"), "execution_id"), "business_id")
    k = j.groupBy("execution_id").agg(F.sum("_n").cast("bigint").alias("review_rows"))
    return e.join(k.withColumnRenamed("execution_id", "id"), "id").select("id", "search_query", "review_rows")


def run_totals_check(e_with_totals: DataFrame, b: DataFrame, r: DataFrame) -> DataFrame:
    """J7 / test 7.1: recorded vs actual businesses and reviews per run."""
    per = r.groupBy("business_id").agg(F.count("id").alias("_n"))
    bb = b.select(F.col("id").alias("business_id"), "execution_id").join(per, "business_id", "left")
    k = bb.groupBy("execution_id").agg(F.count(F.lit(1)).alias("actual_businesses"),
                                       F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("actual_reviews"))
    j = e_with_totals.join(k.withColumnRenamed("execution_id", "id"), "id", "left")
    return j.select("id", "search_query", "total_businesses",
                    F.coalesce("actual_businesses", F.lit(0)).alias("actual_businesses"),
                    F.coalesce("actual_reviews", F.lit(0)).cast("bigint").alias("actual_reviews"))


# ---------------------------------------------------------------------------
# view compositions
# ---------------------------------------------------------------------------
def view_row_counts(views: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of one-row counts per view."""
    out = None
    for name, df in views.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("view"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def shared_facts(r: DataFrame, as_of: _dt.date = AS_OF) -> DataFrame:
    """Per-business review counters written once for several views (one review scan)."""
    return materialize(V.review_facts(r, as_of), "review_facts")


def score_ranges(b: DataFrame, r: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """MIN/MAX of each view's score column (one shared review scan)."""
    facts = shared_facts(r) if facts is None else facts
    parts = [
        ("opportunity_score", V.niche_opportunities(b, ordered=False)),
        ("inc_score", V.market_leaders(b, r, ordered=False, facts=facts)),
        ("vulnerability_score", V.vulnerable_players(b, r, ordered=False, facts=facts)),
        ("newsletter_viability_score", V.business_model_opportunities(b, r, ordered=False, facts=facts)),
    ]
    out = None
    for col, df in parts:
        one = df.agg(F.min(col).cast("double").alias("min_score"),
                     F.max(col).cast("double").alias("max_score")).select(F.lit(col).alias("score"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def market_report(b: DataFrame, r: DataFrame, category: str = DEFAULT_CATEGORY,
                  city: str = DEFAULT_CITY) -> DataFrame:
    """Q25: saturation + gaps + business model + SWOT for one (category, city).

    The scope filter is applied to ``businesses`` and semi-joined into
    reviews before any aggregation.
    """
    bs = b.filter((F.col("category") == category) & (F.col("city") == city))
    # one scan of the reviews, summed per business, serves all three review-based views
    rs = scope_reviews(r, bs)
    facts = materialize(V.review_facts(rs), "report_facts")
    keys = ["category", "city"]
    v1 = V.niche_opportunities(bs, ordered=False).select(*keys, "opportunity_score", "saturation_level",
                                                          "business_count")
    v6 = V.niche_service_gaps(bs, rs, ordered=False, facts=facts).filter(
        F.col("gap_status").isin("CRITICAL_GAP", "HIGH_OPPORTUNITY"))
    gaps = v6.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list("specialty_type")), ", ")
                                 .alias("gap_specialties"))
    v7 = V.business_model_opportunities(bs, rs, ordered=False, facts=facts).select(
        *keys, "newsletter_viability_score", "arbitrage_potential", "ticket_classification", "customer_type",
        "business_model_recommendation")
    v8 = V.niche_swot_analysis(bs, rs, ordered=False, facts=facts).select(
        *keys, "primary_strength", "primary_weakness", "strategic_opportunity", "market_maturity")
    return v1.join(gaps, keys, "left").join(v7, keys, "left").join(v8, keys, "left")


def market_entry(b: DataFrame, r: DataFrame, min_opportunity: int = 7, min_momentum: float = 1.0,
                 max_inc: float = 70.0, facts: DataFrame | None = None) -> DataFrame:
    """Q26: underserved + growing + critical gap, excluding markets with a strong incumbent."""
    keys = ["category", "city"]
    facts = shared_facts(r) if facts is None else facts
    v1 = V.niche_opportunities(b, ordered=False).filter(F.col("opportunity_score") >= min_opportunity) \
        .select(*keys, "opportunity_score")
    v5 = V.review_velocity_trends(b, r, ordered=False, facts=facts).filter(F.col("momentum_ratio") >= min_momentum) \
        .select(*keys, "momentum_ratio")
    v6 = V.niche_service_gaps(b, r, ordered=False, facts=facts).filter(F.col("gap_status") == "CRITICAL_GAP") \
        .select(*keys, "specialty_type", "customer_demand")
    strong = V.market_leaders(b, r, ordered=False, facts=facts).filter(F.col("inc_score") >= max_inc).select(*keys)
    return v1.join(v5, keys).join(v6, keys).join(strong, keys, "left_anti")


def competitive_intel(b: DataFrame, r: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Q26 use case 2: leaders, vulnerable targets, SWOT weakness and pain point per market.

    V2, V3, V4 and V8 share one per-business facts scan.  Everything meets at (category, city) with plain equi-joins (NULL
    keys drop out, as in the reference's USING joins).
    """
    keys = ["category", "city"]
    facts = shared_facts(r) if facts is None else facts
    leaders = (V.market_leaders(b, r, ordered=False, facts=facts)
               .groupBy(*keys).agg(
                   F.count(F.when(F.col("market_position").isin("DOMINANT_LEADER", "STRONG_INCUMBENT"), 1))
                   .alias("strong_incumbents"),
                   F.max("inc_score").alias("top_inc_score")))
    vulnerable = (V.vulnerable_players(b, r, ordered=False, facts=facts)
                  .groupBy(*keys).agg(F.count(F.lit(1)).alias("vulnerable_targets")))
    swot = V.niche_swot_analysis(b, r, ordered=False, facts=facts).select(
        *keys, "primary_weakness", "strategic_opportunity")
    pain = V.customer_pain_points(b, r, ordered=False, facts=facts, texts=False).select(*keys, "primary_pain_point")
    return (leaders.join(swot, keys).join(pain, keys, "left").join(vulnerable, keys, "left")
            .select(*keys, "strong_incumbents", "top_inc_score",
                    F.coalesce("vulnerable_targets", F.lit(0)).alias("vulnerable_targets"),
                    "primary_weakness", "strategic_opportunity", "primary_pain_point"))


def model_validation(b: DataFrame, r: DataFrame, min_viability: float = 60.0) -> DataFrame:
    """Q26 use case 3: viable newsletter markets with their arbitrage and ICP profile."""
    return (V.business_model_opportunities(b, r, ordered=False)
            .filter(F.col("newsletter_viability_score") >= min_viability)
            .select("category", "city", "newsletter_viability_score", "arbitrage_potential",
                    "market_fragmentation", "ticket_classification", "customer_type"))


def product_development(b: DataFrame, r: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Q26 use case 4: critical specialty gaps with the market's primary pain point."""
    keys = ["category", "city"]
    facts = shared_facts(r) if facts is None else facts
    gaps = V.niche_service_gaps(b, r, ordered=False, facts=facts).filter(F.col("gap_status") == "CRITICAL_GAP").select(
        *keys, "specialty_type", "customer_demand", "sentiment_when_mentioned", "positioning_strategy")
    pain = V.customer_pain_points(b, r, ordered=False, facts=facts, texts=False).select(*keys, "primary_pain_point")
    return gaps.join(pain, keys, "left")
