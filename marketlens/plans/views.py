"""The ten analytic views as DataFrame plans.

Shape shared by every review-based view, chosen for 100 TB:

1. project the few review columns needed (Parquet pruning) and compute
   flags JVM-side;
2. **pre-aggregate per ``business_id``** — partial aggregation combines
   map-side, so a business holding a third of all reviews collapses to one
   row per task before the shuffle;
3. join that one-row-per-business result to a slim projection of
   ``businesses`` (no review-grain join, no skewed join key);
4. roll up to (category, city) with another partial/final aggregate.

Time windows use an explicit ``as_of`` date instead of CURRENT_DATE so the
results are reproducible.  Functions return lazy DataFrames; ``ordered``
applies the reference's ORDER BY.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import themes as T
from marketlens.functions.jsonops import DOCUMENT, document, text_at
from marketlens.operators.joined_text import PIECE, joined_pieces, joined_texts
from marketlens.functions.scalar import dround, pct, safe_div
from marketlens.sources.fixture import AS_OF

# Salt fan-out for top-k per group: spreads a hot (category, city) group over
# this many tasks in the first top-k stage.
TOPK_SALTS = 32


def _d(x) -> Column:
    return F.lit(x).cast("double")


def _cutoff(as_of: _dt.date, days: int) -> Column:
    return F.date_sub(F.lit(as_of), days)


# ---------------------------------------------------------------------------
# V1 niche_opportunities
# ---------------------------------------------------------------------------
def top_players(b: DataFrame, keys: list[str], k: int = 3, min_rating: float = 4.5,
                salts: int = TOPK_SALTS) -> DataFrame:
    """Top-``k`` business names per group among rating >= ``min_rating``.

    Order: rating desc, review_count desc (NULLs first, as PostgreSQL's
    DESC), then name.  Two-stage so no task sees a whole hot group: rank
    inside (keys, salt) and keep ≤k candidates per salt, then a bounded
    ``collect_list`` (≤ k·salts structs per group) is sorted and sliced.
    Returns keys + ``top_players`` (NULL when no business qualifies).
    """
    rc = F.col("review_count")
    sort_key = F.struct(
        (-F.col("rating")).alias("r"),
        F.when(rc.isNull(), 0).otherwise(1).alias("rn"),
        (-F.coalesce(rc, F.lit(0))).alias("c"),
        F.col("business_name").alias("name"),
    )
    cand = (b.filter(F.col("rating") >= F.lit(min_rating))
            .select(*keys, sort_key.alias("sk"),
                    F.pmod(F.xxhash64("id"), F.lit(salts)).alias("_salt")))
    w = Window.partitionBy(*keys, "_salt").orderBy("sk")
    cand = cand.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k)
    top = cand.groupBy(*keys).agg(F.sort_array(F.collect_list("sk")).alias("_arr"))
    names = F.transform(F.slice(F.col("_arr"), 1, k), lambda s: s["name"])
    return top.select(*keys, names.alias("top_players"))


def niche_opportunities(businesses: DataFrame, ordered: bool = True) -> DataFrame:
    keys = ["category", "city"]
    b = businesses.select("id", "business_name", "category", "city", "rating",
                          "review_count", "created_at").filter(F.col("category").isNotNull())
    n = F.count(F.lit(1))
    stats = b.groupBy(*keys).agg(
        n.alias("business_count"),
        F.avg("rating").alias("_avg"),
        F.sum("review_count").cast("bigint").alias("total_category_reviews"),
        F.max("created_at").alias("last_updated"),
    )
    top = top_players(b, keys)
    # null-safe key match: a NULL city is a group of its own
    j = stats.join(top, [stats[c].eqNullSafe(top[c]) for c in keys], "left")
    cnt = stats["business_count"]
    tot = stats["total_category_reviews"]
    out = j.select(
        stats["category"], stats["city"], cnt,
        dround(stats["_avg"], 2).alias("avg_category_rating"),
        tot,
        F.when(cnt >= 50, "HIGH_SATURATION")
        .when(cnt.between(10, 49), "MEDIUM_SATURATION")
        .when(cnt.between(5, 9), "LOW_COMPETITION")
        .otherwise("WIDE_OPEN").alias("saturation_level"),
        F.when((cnt < 5) & (tot > 100), 10)
        .when(cnt < 10, 8)
        .when(cnt.between(10, 30), 6)
        .when(cnt.between(31, 50), 4)
        .otherwise(2).alias("opportunity_score"),
        top["top_players"],
        stats["last_updated"],
    )
    if ordered:
        out = out.orderBy(F.desc("opportunity_score"), F.asc("business_count"))
    return out


# ---------------------------------------------------------------------------
# helpers shared by review views
# ---------------------------------------------------------------------------
def _attach(per_biz: DataFrame, businesses: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join a one-row-per-business aggregate to business attributes."""
    b = businesses.select(F.col("id").alias("business_id"), *cols)
    if how == "left":
        return b.join(per_biz, "business_id", "left")
    return per_biz.join(b, "business_id", "inner")


# Per-business counters each view needs.  ``review_facts`` computes all of
# them in one grouped scan of the review table; a view given ``facts`` skips
# its own scan.  Names are unique across views so one table serves all.
def _agg_common() -> list[Column]:
    s = F.col("stars")
    return [F.count(F.lit(1)).alias("n_reviews"), F.sum(s).alias("stars_sum"), F.count(s).alias("stars_n")]


def _agg_time(as_of: _dt.date) -> list[Column]:
    d, s = F.col("published_at"), F.col("stars")
    c90, c180 = _cutoff(as_of, 90), _cutoff(as_of, 180)
    recent, hist = d >= c90, d < c90
    return [
        F.count(F.when(recent, 1)).alias("recent_n"),                       # V3, V4, V5
        F.sum(F.when(recent, s)).alias("recent_stars_sum"), F.count(F.when(recent, s)).alias("recent_stars_n"),
        F.sum(F.when(hist, s)).alias("hist_stars_sum"), F.count(F.when(hist, s)).alias("hist_stars_n"),
        F.count(F.when(recent & (s <= 2), 1)).alias("recent_negative_n"),
        F.count(F.when((d >= c180) & (d < c90), 1)).alias("previous_n"),    # V5
    ]


def _agg_model() -> list[Column]:
    text, stars = F.col("review_text"), F.col("stars")
    hi = T.flag(text.rlike(T.HIGH_TICKET_AMOUNT) | T.has_words(text, T.HIGH_TICKET_WORDS))
    return [
        F.sum(hi).alias("high_ticket_n"),
        F.sum(T.flag(T.has_words(text, T.B2B_WORDS))).alias("b2b_n"),
        F.sum(T.flag(T.has_words(text, T.B2C_WORDS))).alias("b2c_n"),
        F.sum(T.flag((stars <= 2) & T.has_words(text, T.TRUST_WORDS))).alias("trust_n"),
    ]


def _agg_swot() -> list[Column]:
    text, stars = F.col("review_text"), F.col("stars")
    pos, neg = stars >= 4, stars <= 3
    aggs = [F.sum(T.flag(pos & T.has_words(text, T.STRENGTH_THEMES[k]))).alias(f"p_{k}") for k in _THEMES4]
    aggs.append(F.count(F.when(pos, 1)).alias("p_total"))
    aggs += [F.sum(T.flag(neg & T.has_words(text, T.WEAKNESS_THEMES[k]))).alias(f"n_{k}") for k in _THEMES4]
    aggs.append(F.count(F.when(neg, 1)).alias("n_total"))
    return aggs


def _agg_pain() -> list[Column]:
    """Counters of V2 over reviews of up to two stars with a text."""
    text = F.col("review_text")
    low = (F.col("stars") <= 2) & text.isNotNull()
    return [*[F.sum(T.flag(low & T.has_words(text, v))).alias(f"{k}_complaints") for k, v in T.PAIN_THEMES.items()],
            F.count(F.when(low, 1)).alias("total_complaints")]


def _agg_keywords() -> list[Column]:
    """Mentions of each specialty (V6): how many, and the sum and number of the stars of their reviews, mention by mention."""
    out = []
    for i, kw in enumerate(T.SERVICE_KEYWORDS):
        n = F.size(F.filter("_mentions", F.lit(kw).__eq__))
        rated = F.when(F.col("stars").isNotNull(), n).otherwise(0)
        out += [F.sum(n).alias(f"kw{i}_n"), F.sum(rated * F.coalesce("stars", F.lit(0))).alias(f"kw{i}_ss"), F.sum(rated).alias(f"kw{i}_sn")]
    return out


def _mentions() -> Column:
    pattern = r"\b(" + "|".join(T.SERVICE_KEYWORDS) + r")\b"
    found = F.regexp_extract_all(F.lower("review_text"), F.lit(pattern), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>")).alias("_mentions")


def _per(reviews: DataFrame, facts: DataFrame | None, aggs: list[Column]) -> DataFrame:
    return facts if facts is not None else reviews.groupBy("business_id").agg(*aggs)


def review_facts(reviews: DataFrame, as_of: _dt.date = AS_OF) -> DataFrame:
    """One row per business with every counter of V2 to V9.

    A single grouped scan of the (large) review table — partial aggregation
    map-side, one shuffle of at most one row per business per task — that
    multi-view consumers share instead of scanning reviews once per view.
    """
    return (reviews.select("business_id", "stars", "review_text", "published_at", _mentions())
            .groupBy("business_id")
            .agg(*_agg_common(), *_agg_time(as_of), *_agg_model(), *_agg_swot(), *_agg_pain(), *_agg_keywords()))


# ---------------------------------------------------------------------------
# V2 customer_pain_points
# ---------------------------------------------------------------------------
PAIN_LABELS = (
    ("pricing", "Pricing Transparency"),
    ("scheduling", "Scheduling Flexibility"),
    ("quality", "Service Quality"),
    ("communication", "Professional Communication"),
)


def _low_star_texts(reviews: DataFrame) -> DataFrame:
    return reviews.select(*[c for c in ("id", "business_id", "stars", "review_text") if c in reviews.columns]).filter((F.col("stars") <= 2) & F.col("review_text").isNotNull())


def customer_pain_points(businesses: DataFrame, reviews: DataFrame, ordered: bool = True,
                         facts: DataFrame | None = None, texts: bool = True) -> DataFrame:
    """One scan of the negative reviews, summed per business, then per market.

    With ``texts``, ``sample_complaints`` joins the market's 1-star snippets
    (:func:`complaint_pieces`); without, no text is read for it.
    """
    keys = ["category", "city"]
    per = facts if facts is not None else _low_star_texts(reviews).groupBy("business_id").agg(*_agg_pain())
    sums = [f"{k}_complaints" for k in T.PAIN_THEMES] + ["total_complaints"]
    grp = _attach(per.select("business_id", *sums), businesses, keys).groupBy(*keys).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in sums]).filter(F.col("total_complaints") >= 3)
    tot = F.col("total_complaints")
    cols = [F.col("category"), F.col("city"), tot]
    for k in T.PAIN_THEMES:
        c = F.col(f"{k}_complaints")
        cols += [c, pct(c, tot).alias(f"{k}_pct")]
    allc = {k: F.col(f"{k}_complaints") for k in T.PAIN_THEMES}
    primary = None
    for k, label in PAIN_LABELS:
        others = [v for kk, v in allc.items() if kk != k]
        cond = allc[k] >= F.greatest(*others)
        primary = F.when(cond, label) if primary is None else primary.when(cond, label)
    primary = primary.otherwise("Availability & Hours")
    out = grp.select(*cols, primary.alias("primary_pain_point"))
    if texts:
        joined = joined_texts(complaint_pieces(businesses, reviews), keys, "sample_complaints").withColumnsRenamed({k: f"_{k}" for k in keys})
        same = F.col("category").eqNullSafe(F.col("_category")) & F.col("city").eqNullSafe(F.col("_city"))
        out = out.join(joined, same, "left").drop("_category", "_city")
    if ordered:
        out = out.orderBy(F.desc("total_complaints"))
    return out


def complaint_snippets(businesses: DataFrame, reviews: DataFrame) -> DataFrame:
    """The 1-star texts of the markets of V2 as rows: (category, city, snippet, mentions).

    Equal snippets are counted in their business first; markets with fewer
    than three complaints have none, as in the view.
    """
    keys = ["category", "city"]
    low = _low_star_texts(reviews)
    owner = businesses.select(F.col("id").alias("business_id"), *keys)
    markets = (low.groupBy("business_id").agg(F.count(F.lit(1)).alias("n")).join(owner, "business_id")
               .groupBy(*keys).agg(F.sum("n").alias("n")).filter(F.col("n") >= 3)
               .select(F.col("category").alias("_category"), F.col("city").alias("_city")))
    per = (low.filter(F.col("stars") == 1).groupBy("business_id", F.substring("review_text", 1, 100).alias("snippet"))
           .agg(F.count(F.lit(1)).alias("m")).join(owner, "business_id")
           .groupBy(*keys, "snippet").agg(F.sum("m").cast("bigint").alias("mentions")))
    same = F.col("category").eqNullSafe(F.col("_category")) & F.col("city").eqNullSafe(F.col("_city"))
    return per.join(markets, same, "left_semi")


def complaint_pieces(businesses: DataFrame, reviews: DataFrame, piece: int = PIECE) -> DataFrame:
    """Each market's 1-star snippets joined by `` | `` in their order, in pieces (category, city, part, text)."""
    keys = ["category", "city"]
    owner = businesses.select(F.col("id").alias("business_id"), *keys)
    rows = _low_star_texts(reviews).filter(F.col("stars") == 1).select("id", "business_id", F.substring("review_text", 1, 100).alias("snippet")).join(owner, "business_id")
    return joined_pieces(rows, keys, "snippet", ["snippet", "id"], " | ", piece)


def joined_complaints(businesses: DataFrame, reviews: DataFrame) -> DataFrame:
    """Each market's snippets as one text; it must fit a row."""
    return joined_texts(complaint_pieces(businesses, reviews), ["category", "city"], "sample_complaints")


# ---------------------------------------------------------------------------
# V3 market_leaders
# ---------------------------------------------------------------------------
_DOC_SCHEMA = ("struct<social:struct<instagrams:string,facebookPages:string>,"
               "rating:struct<reviewsDistribution:struct<oneStar:string,twoStar:string,"
               "threeStar:string,fourStar:string,fiveStar:string>>>")
_DIST_KEYS = ("oneStar", "twoStar", "threeStar", "fourStar", "fiveStar")


def parse_document(businesses: DataFrame) -> Column:
    """The paths that V3 reads, as a struct: fields of the stored VARIANT, or one ``from_json`` parse where there is only text."""
    if DOCUMENT not in businesses.columns:
        return F.from_json(F.col("business_data"), _DOC_SCHEMA)
    at = lambda *path: text_at(F.col(DOCUMENT), *path).alias(path[-1])
    stars = F.struct(*[at("rating", "reviewsDistribution", k) for k in _DIST_KEYS]).alias("reviewsDistribution")
    return F.struct(F.struct(*[at("social", k) for k in ("instagrams", "facebookPages")]).alias("social"),
                    F.struct(stars).alias("rating"))


def market_leaders(businesses: DataFrame, reviews: DataFrame, as_of: _dt.date = AS_OF,
                   ordered: bool = True, facts: DataFrame | None = None) -> DataFrame:
    recent = _per(reviews.select("business_id", "published_at"), facts,
                  [F.count(F.when(F.col("published_at") >= _cutoff(as_of, 90), 1)).alias("recent_n")])
    b = businesses.select("id", "business_name", "category", "city", "rating", "review_count",
                          "website", "phone", parse_document(businesses).alias("_doc"))
    b = b.filter(F.col("review_count") >= 20)   # WHERE on a group column: push below the join
    j = b.join(recent.withColumnRenamed("business_id", "id"), "id", "left")
    c = F.coalesce(F.col("rating"), F.lit(3.0).cast("decimal(2,1)"))
    dist = F.col("_doc.rating.reviewsDistribution")
    ssq = None
    for i, key in enumerate(_DIST_KEYS, start=1):
        dev = F.lit(i).cast("decimal(2,1)") - c
        term = dev * dev * F.coalesce(dist[key].cast("int"), F.lit(0))
        ssq = term if ssq is None else ssq + term
    variance = F.coalesce(F.sqrt(ssq.cast("double") / F.nullif(F.col("review_count"), F.lit(0))), _d(0.5))
    rec = F.coalesce(F.col("recent_n"), F.lit(0)).cast("bigint")
    social = F.col("_doc.social")
    digital = (F.when(social["instagrams"].isNotNull(), 1).otherwise(0)
               + F.when(social["facebookPages"].isNotNull(), 1).otherwise(0)
               + F.when(F.col("website").isNotNull() & (F.col("website") != ""), 1).otherwise(0))
    m = j.select("id", "business_name", "category", "city", "rating", "review_count", "website", "phone",
                 variance.alias("rating_variance"), rec.alias("recent_reviews_90d"),
                 digital.alias("digital_presence_score"))
    rating_d = F.coalesce(F.col("rating").cast("double"), _d(0.0))
    score = (rating_d / 5.0 * 40
             + F.least(F.coalesce(F.col("review_count"), F.lit(0)).cast("double") / 200, _d(1.0)) * 30
             + (1.0 - F.least(F.col("rating_variance"), _d(1.0))) * 20
             + F.least(F.col("recent_reviews_90d").cast("double") / 20, _d(1.0)) * 10)
    r, n = F.col("rating"), F.col("review_count")
    pos = (F.when((r >= 4.5) & (n >= 100), "DOMINANT_LEADER")
           .when((r >= 4.3) & (n >= 50), "STRONG_INCUMBENT")
           .when((r >= 4.0) & (n >= 30), "ESTABLISHED_PLAYER")
           .otherwise("EMERGING_BUSINESS"))
    out = m.select("*", dround(score, 1).alias("inc_score"), pos.alias("market_position"))
    if ordered:
        out = out.orderBy(F.desc_nulls_first("inc_score"))
    return out


# ---------------------------------------------------------------------------
# V4 vulnerable_players
# ---------------------------------------------------------------------------
def vulnerable_players(businesses: DataFrame, reviews: DataFrame, as_of: _dt.date = AS_OF,
                       ordered: bool = True, facts: DataFrame | None = None) -> DataFrame:
    per = _per(reviews.select("business_id", "stars", "published_at"), facts,
               [F.count(F.lit(1)).alias("n_reviews"), *_agg_time(as_of)])
    j = _attach(per, businesses, ["business_name", "category", "city", "rating", "review_count"], "left")
    # LEFT JOIN + COUNT(*): a business without reviews still counts one row
    rows = F.greatest(F.coalesce(F.col("n_reviews"), F.lit(0)), F.lit(1))
    j = j.filter(rows >= 10)
    base = j.select(
        F.col("business_id").alias("id"), "business_name", "category", "city",
        F.col("rating").alias("overall_rating"), "review_count",
        safe_div(F.col("recent_stars_sum"), F.col("recent_stars_n")).alias("recent_rating_90d"),
        safe_div(F.col("hist_stars_sum"), F.col("hist_stars_n")).alias("historical_rating"),
        F.coalesce(F.col("recent_n"), F.lit(0)).alias("recent_review_count"),
        F.coalesce(F.col("recent_negative_n"), F.lit(0)).alias("recent_negative_reviews"),
    )
    rec, hist = F.col("recent_rating_90d"), F.col("historical_rating")
    base = base.filter((rec < hist - 0.2) | (rec < 3.5))
    neg_ratio = F.col("recent_negative_reviews").cast("double") / F.nullif(F.col("recent_review_count"), F.lit(0))
    rc = F.col("review_count")
    score = (F.greatest((hist - rec) / 2.0 * 40, _d(0.0))
             + (1.0 - F.coalesce(rec, F.col("overall_rating").cast("double")) / 5.0) * 30
             + neg_ratio * 20
             + F.least(rc.cast("double") / 100, _d(1.0)) * 10)
    cls = (F.when((rec < hist - 0.5) & (rc > 50), "HIGH_DISRUPTION_TARGET")
           .when((rec < 3.5) & (rc > 30), "DECLINING_INCUMBENT")
           .when(neg_ratio > 0.3, "REPUTATION_CRISIS")
           .otherwise("MODERATE_VULNERABILITY"))
    out = base.select("*", dround(rec - hist, 2).alias("rating_momentum"),
                      dround(score, 1).alias("vulnerability_score"),
                      cls.alias("vulnerability_classification"))
    if ordered:
        out = out.orderBy(F.desc_nulls_first("vulnerability_score"))
    return out


# ---------------------------------------------------------------------------
# V5 review_velocity_trends
# ---------------------------------------------------------------------------
def review_velocity_trends(businesses: DataFrame, reviews: DataFrame, as_of: _dt.date = AS_OF,
                           ordered: bool = True, facts: DataFrame | None = None) -> DataFrame:
    keys = ["category", "city"]
    d = F.col("published_at")
    c90, c180 = _cutoff(as_of, 90), _cutoff(as_of, 180)
    per = _per(reviews.select("business_id", "published_at"), facts, [
        F.count(F.when(d >= c90, 1)).alias("recent_n"),
        F.count(F.when((d >= c180) & (d < c90), 1)).alias("previous_n"),
        F.count(F.lit(1)).alias("n_reviews"),
    ])
    b = businesses.filter(F.col("category").isNotNull())
    j = _attach(per, b, keys, "left")
    g = j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("business_count"),   # one row per business id
        F.sum(F.greatest(F.coalesce(F.col("n_reviews"), F.lit(0)), F.lit(1))).cast("bigint").alias("total_reviews"),
        F.sum(F.coalesce(F.col("recent_n"), F.lit(0))).cast("bigint").alias("reviews_current_90d"),
        F.sum(F.coalesce(F.col("previous_n"), F.lit(0))).cast("bigint").alias("reviews_previous_90d"),
    ).filter((F.col("business_count") >= 3) & (F.col("reviews_previous_90d") > 0))
    cur = F.col("reviews_current_90d").cast("double")
    n = F.col("business_count")
    ratio = cur / F.nullif(F.col("reviews_previous_90d"), F.lit(0))
    per_b = cur / n
    out = g.select(
        *keys, "business_count", "total_reviews", "reviews_current_90d", "reviews_previous_90d",
        dround(cur / F.nullif(n, F.lit(0)) / 90, 3).alias("velocity_per_business_per_day"),
        dround(ratio, 2).alias("momentum_ratio"),
        F.when(ratio >= 1.5, "RAPID_GROWTH").when(ratio >= 1.1, "GROWING").when(ratio >= 0.9, "STABLE")
        .when(ratio >= 0.7, "DECLINING").otherwise("RAPID_DECLINE").alias("trend_classification"),
        F.when(per_b >= 30, "HOT").when(per_b >= 15, "WARM").when(per_b >= 5, "COOL")
        .otherwise("COLD").alias("market_temperature"),
    )
    if ordered:
        out = out.orderBy(F.desc_nulls_first("momentum_ratio"))
    return out


# ---------------------------------------------------------------------------
# V6 niche_service_gaps
# ---------------------------------------------------------------------------
def keyword_mentions(reviews: DataFrame) -> DataFrame:
    """One row per whole-word specialty occurrence in lower(text)."""
    pat = r"\b(" + "|".join(T.SERVICE_KEYWORDS) + r")\b"
    return (reviews.filter(F.col("review_text").isNotNull())
            .select("business_id", "stars",
                    F.explode(F.regexp_extract_all(F.lower("review_text"), F.lit(pat), 1))
                    .alias("service_keyword")))


def service_supply(businesses: DataFrame) -> DataFrame:
    """Businesses whose lower(name) or lower(document) contains a specialty.

    The lateral join with the 12 keywords is an array ``filter`` + ``explode``
    inside one projection — no nested-loop join.
    """
    kws = F.array(*[F.lit(k) for k in T.SERVICE_KEYWORDS])
    name, doc = F.lower("business_name"), F.lower("business_data")
    hits = F.filter(kws, lambda k: F.contains(name, k) | F.contains(doc, k))
    return (businesses.select("category", "city", F.explode(hits).alias("service_keyword"))
            .groupBy("category", "city", "service_keyword")
            .agg(F.count(F.lit(1)).alias("provider_count")))


def niche_service_gaps(businesses: DataFrame, reviews: DataFrame, ordered: bool = True,
                       facts: DataFrame | None = None) -> DataFrame:
    keys = ["category", "city"]
    if facts is not None:
        each = F.array(*[F.struct(F.lit(kw).alias("service_keyword"), F.col(f"kw{i}_n").alias("_n"), F.col(f"kw{i}_ss").alias("_ss"),
                                  F.col(f"kw{i}_sn").alias("_sn")) for i, kw in enumerate(T.SERVICE_KEYWORDS)])
        per = facts.select("business_id", F.inline(F.filter(each, lambda x: x["_n"] > 0)))
    else:
        m = keyword_mentions(reviews.select("business_id", "stars", "review_text"))
        per = m.groupBy("business_id", "service_keyword").agg(
            F.count(F.lit(1)).alias("_n"), F.sum("stars").alias("_ss"), F.count("stars").alias("_sn"))
    demand = (_attach(per, businesses, keys)
              .groupBy(*keys, "service_keyword")
              .agg(F.sum("_n").cast("bigint").alias("mention_frequency"),
                   F.sum("_ss").alias("_ss"), F.sum("_sn").alias("_sn"))
              .filter(F.col("mention_frequency") >= 5))
    supply = service_supply(businesses)
    # plain equi-join: NULL category/city never matches (USING semantics)
    j = demand.join(supply, keys + ["service_keyword"], "left")
    s = F.coalesce(F.col("provider_count"), F.lit(0)).cast("bigint")
    d = F.col("mention_frequency")
    kw = F.col("service_keyword")
    gap = (F.when((s == 0) & (d >= 10), "CRITICAL_GAP")
           .when((s <= 2) & (d >= 15), "HIGH_OPPORTUNITY")
           .when((s <= 5) & (d >= 20), "MODERATE_GAP")
           .otherwise("SERVED"))
    posn = (F.when(kw.isin("emergency", "24/7", "weekend"), "Position as always-available specialist")
            .when(kw.isin("custom", "design", "consultation"), "Emphasize premium, personalized service")
            .when(kw.isin("repair", "restoration", "maintenance"), "Focus on reliability and warranty guarantees")
            .otherwise(F.concat(F.lit("Differentiate on "), kw, F.lit(" expertise"))))
    out = j.select(
        *keys, kw.alias("specialty_type"), d.alias("customer_demand"), s.alias("current_providers"),
        dround(safe_div(F.col("_ss"), F.col("_sn")), 2).alias("sentiment_when_mentioned"),
        dround(d.cast("double") / F.greatest(s, F.lit(1)), 2).alias("demand_supply_ratio"),
        gap.alias("gap_status"), posn.alias("positioning_strategy"),
    )
    if ordered:
        rank = (F.when((F.col("current_providers") == 0) & (F.col("customer_demand") >= 10), 1)
                .when((F.col("current_providers") <= 2) & (F.col("customer_demand") >= 15), 2).otherwise(3))
        out = out.orderBy(rank, F.desc("customer_demand"))
    return out


# ---------------------------------------------------------------------------
# V7 business_model_opportunities
# ---------------------------------------------------------------------------
def business_model_opportunities(businesses: DataFrame, reviews: DataFrame,
                                 ordered: bool = True, facts: DataFrame | None = None) -> DataFrame:
    keys = ["category", "city"]
    per = _per(reviews.select("business_id", "stars", "review_text"), facts,
               [F.count(F.lit(1)).alias("n_reviews"), *_agg_model()])
    j = _attach(per, businesses, keys + ["rating"])
    # stddev of b.rating over joined review rows, from exact integer moments:
    # x = 10·rating is integral; Σn, Σn·x, Σn·x² are decimal(38,0) sums.
    x = (F.col("rating") * 10).cast("decimal(38,0)")
    nn = F.col("n_reviews").cast("decimal(38,0)")
    g = j.groupBy(*keys).agg(
        F.sum("high_ticket_n").cast("bigint").alias("high_ticket_mentions"),
        F.sum("n_reviews").cast("bigint").alias("total_reviews"),
        F.count(F.lit(1)).alias("provider_count"),
        F.sum(F.when(x.isNotNull(), nn)).alias("_m0"),
        F.sum(nn * x).alias("_m1"),
        F.sum(nn * x * x).alias("_m2"),
        F.sum("b2b_n").cast("bigint").alias("b2b_signals"),
        F.sum("b2c_n").cast("bigint").alias("b2c_signals"),
        F.sum("trust_n").cast("bigint").alias("trust_issues"),
    ).filter(F.col("total_reviews") >= 20)
    m0, m1, m2 = F.col("_m0"), F.col("_m1"), F.col("_m2")
    var_num = (m0 * m2 - m1 * m1).cast("double")
    var_den = (m0 * (m0 - 1)).cast("double") * 100.0
    sd = F.when(m0 > 1, F.sqrt(F.greatest(var_num, _d(0.0)) / var_den))
    g = g.withColumn("_sd", sd)
    tot = F.col("total_reviews")
    h = F.col("high_ticket_mentions").cast("double") / F.nullif(tot, F.lit(0))
    sdc, n = F.col("_sd"), F.col("provider_count")
    trust, b2b, b2c = F.col("trust_issues"), F.col("b2b_signals"), F.col("b2c_signals")
    ticket = (F.when(h > 0.25, "PREMIUM_PRICING").when(h > 0.15, "HIGH_TICKET")
              .when(h > 0.08, "MID_TICKET").otherwise("LOW_TICKET"))
    arb = (F.when((n > 20) & (sdc > 0.6) & (h > 0.15) & (trust > 5), "EXCELLENT_ARBITRAGE")
           .when((n > 15) & (sdc > 0.4) & (h > 0.10), "GOOD_ARBITRAGE")
           .when((n > 10) & (sdc > 0.3), "MODERATE_ARBITRAGE")
           .otherwise("LOW_ARBITRAGE"))
    cust = (F.when(b2b > b2c * 3, "B2B_FOCUSED").when(b2c > b2b * 3, "B2C_FOCUSED")
            .when(b2b > b2c * 1.5, "B2B_LEANING").when(b2c > b2b * 1.5, "B2C_LEANING")
            .otherwise("MIXED_MARKET"))
    score = (F.least(sdc * 40, _d(40.0)) + h * 30
             + F.least(trust.cast("double") / F.nullif(tot, F.lit(0)) * 100, _d(20.0))
             + F.least(n.cast("double") / 50 * 10, _d(10.0)))
    rec = (F.when((sdc > 0.6) & (h > 0.15), 'High-value curation newsletter: "Vetted Premium Providers"')
           .when((trust > 5) & (n > 15), 'Trust-focused aggregator: "Certified & Reviewed Professionals"')
           .when(b2b > b2c * 2, "B2B lead generation platform targeting property managers")
           .when((n > 30) & (sdc > 0.4), "Local marketplace with quality guarantees")
           .otherwise("Standard directory/referral newsletter"))
    out = g.select(
        *keys, "provider_count", "total_reviews",
        pct(F.col("high_ticket_mentions"), tot).alias("high_ticket_pct"),
        ticket.alias("ticket_classification"),
        dround(sdc, 2).alias("market_fragmentation"),
        arb.alias("arbitrage_potential"),
        "b2b_signals", "b2c_signals", cust.alias("customer_type"),
        "trust_issues", pct(trust, tot).alias("trust_issue_pct"),
        dround(score, 1).alias("newsletter_viability_score"),
        rec.alias("business_model_recommendation"),
    )
    if ordered:
        out = out.orderBy(F.desc_nulls_first("newsletter_viability_score"))
    return out


# ---------------------------------------------------------------------------
# V8 niche_swot_analysis
# ---------------------------------------------------------------------------
STRENGTH_LABELS = ("Professionalism & Expertise", "Speed & Responsiveness",
                   "Fair & Transparent Pricing", "Quality Workmanship")
WEAKNESS_LABELS = ("Unprofessional Conduct", "Slow/Unreliable Service", "Pricing Issues",
                   "Quality Concerns")
STRENGTH_ITEMS = ("Professional service", "Fast response", "Fair pricing", "Quality work")
WEAKNESS_ITEMS = ("Unprofessional behavior", "Delays & no-shows", "Overpricing & hidden fees",
                  "Poor workmanship")
OPPORTUNITY_TEXTS = (
    "Differentiate on professionalism: Certified technicians, background checks, communication standards",
    "Guarantee response times: Same-day service, real-time tracking, automated scheduling",
    "Transparent pricing model: Upfront quotes, price-match guarantees, no hidden fees",
    "Quality assurance program: Warranties, inspections, satisfaction guarantees",
)
_THEMES4 = ("professionalism", "speed", "pricing", "quality")


def _first_max(cols: list[Column], labels) -> Column:
    """CASE: first theme that is >= the greatest of the others, else last label."""
    out = None
    for i in range(3):
        others = [c for j, c in enumerate(cols) if j != i]
        cond = cols[i] >= F.greatest(*others)
        out = F.when(cond, labels[i]) if out is None else out.when(cond, labels[i])
    return out.otherwise(labels[3])


def niche_swot_analysis(businesses: DataFrame, reviews: DataFrame, ordered: bool = True,
                        facts: DataFrame | None = None) -> DataFrame:
    """Positive (stars ≥4) and negative (stars ≤3) halves in one pass.

    The reference full-joins two grouped halves USING (category, city); NULL
    keys never match there, so a NULL-key group yields two rows.  We compute
    both halves in one aggregate and split NULL-key groups in two with ``explode``.
    """
    keys = ["category", "city"]
    # NULL stars are neither positive nor negative; a business whose reviews
    # are all unrated contributes zeros and its group is dropped below
    per = _per(reviews.select("business_id", "stars", "review_text"), facts, _agg_swot())
    sums = [F.sum(c).cast("bigint").alias(c) for c in
            [f"p_{k}" for k in _THEMES4] + ["p_total"] + [f"n_{k}" for k in _THEMES4] + ["n_total"]]
    g = _attach(per, businesses, keys).groupBy(*keys).agg(*sums)
    pcols = [f"p_{k}" for k in _THEMES4] + ["p_total"]
    ncols = [f"n_{k}" for k in _THEMES4] + ["n_total"]
    null_key = F.col("category").isNull() | F.col("city").isNull()
    # side kinds: 0 = both halves in one row, 1 = positive only, 2 = negative only
    g = g.withColumn("_sides", F.when(null_key, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0))))
    g = g.select("*", F.explode("_sides").alias("_side"))
    side = F.col("_side")
    p_on = (side != 2) & (F.col("p_total") > 0)
    n_on = (side != 1) & (F.col("n_total") > 0)
    g = g.select(*keys,
                 *[F.when(p_on, F.col(c)).alias(c) for c in pcols],
                 *[F.when(n_on, F.col(c)).alias(c) for c in ncols])
    g = g.filter(F.col("p_total").isNotNull() | F.col("n_total").isNotNull())
    g = g.filter(F.coalesce(F.col("p_total"), F.lit(0)) + F.coalesce(F.col("n_total"), F.lit(0)) >= 15)

    pc = [F.col(f"p_{k}") for k in _THEMES4]
    nc = [F.col(f"n_{k}") for k in _THEMES4]
    pt, nt = F.col("p_total"), F.col("n_total")
    slist = F.array_join(F.array(*[F.when(c > pt * 0.1, F.lit(lbl)) for c, lbl in zip(pc, STRENGTH_ITEMS)]), ", ")
    wlist = F.array_join(F.array(*[F.when(c > nt * 0.15, F.lit(lbl)) for c, lbl in zip(nc, WEAKNESS_ITEMS)]), ", ")
    maturity = (F.when(pt > nt * 5, "MATURE_MARKET").when(nt > pt * 0.5, "FRAGMENTED_MARKET")
                .otherwise("DEVELOPING_MARKET"))
    out = g.select(
        *keys,
        _first_max(pc, STRENGTH_LABELS).alias("primary_strength"),
        slist.alias("strength_list"),
        _first_max(nc, WEAKNESS_LABELS).alias("primary_weakness"),
        wlist.alias("weakness_list"),
        _first_max(nc, OPPORTUNITY_TEXTS).alias("strategic_opportunity"),
        maturity.alias("market_maturity"),
        pt.alias("total_positive_reviews"),
        nt.alias("total_negative_reviews"),
    )
    if ordered:
        out = out.orderBy(F.desc_nulls_last("total_negative_reviews"))
    return out


# ---------------------------------------------------------------------------
# V9 business_summary, V10 recent_executions
# ---------------------------------------------------------------------------
def business_summary(businesses: DataFrame, reviews: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    per = _per(reviews.select("business_id", "stars"), facts, _agg_common())
    b = businesses.select("id", "business_name", "city", "category", "rating", "review_count", "phone",
                          "website", "created_at", *[text_at(document(businesses), "social", k).alias("_" + k) for k in ("instagrams", "facebooks")])
    j = b.join(per.withColumnRenamed("business_id", "id"), "id", "left")
    return j.select(
        "id", "business_name", "city", "category", "rating", "review_count", "phone", "website",
        F.coalesce(F.col("n_reviews"), F.lit(0)).alias("stored_reviews"),
        safe_div(F.col("stars_sum"), F.col("stars_n")).alias("avg_review_rating"),
        F.col("_instagrams").alias("instagram"),
        F.col("_facebooks").alias("facebook"),
        "created_at",
    )


def execution_stats(executions: DataFrame, businesses: DataFrame, reviews: DataFrame) -> DataFrame:
    """Run totals by aggregation (never by increment)."""
    b = businesses.select(F.col("id").alias("business_id"), "execution_id")
    nb = b.groupBy("execution_id").agg(F.count(F.lit(1)).alias("total_businesses"))
    per = reviews.groupBy("business_id").agg(F.count(F.lit(1)).alias("_n"))
    nr = per.join(b, "business_id").groupBy("execution_id").agg(
        F.sum("_n").cast("bigint").alias("total_reviews"))
    e = executions.join(nb.withColumnRenamed("execution_id", "id"), "id", "left") \
                  .join(nr.withColumnRenamed("execution_id", "id"), "id", "left")
    return e.select(
        *executions.columns,
        F.coalesce(F.col("total_businesses"), F.lit(0)).cast("bigint").alias("total_businesses"),
        F.coalesce(F.col("total_reviews"), F.lit(0)).cast("bigint").alias("total_reviews"),
    )


def latest_with_totals(executions: DataFrame, businesses: DataFrame, reviews: DataFrame, n: int) -> DataFrame:
    """The newest n runs, with totals counted over their own businesses and reviews only."""
    top = executions.orderBy(F.desc_nulls_first("created_at"), "id").limit(n)
    b = businesses.join(F.broadcast(top.select(F.col("id").alias("execution_id"))), "execution_id", "left_semi")   # n rows
    r = reviews.select("business_id").join(b.select(F.col("id").alias("business_id")), "business_id", "left_semi")
    return execution_stats(top, b, r)


def recent_executions(executions: DataFrame, businesses: DataFrame, reviews: DataFrame, n: int = 50) -> DataFrame:
    e = latest_with_totals(executions, businesses, reviews, n)
    secs = F.timestamp_diff("SECOND", F.col("created_at"), F.col("completed_at"))
    return (e.select("id", "created_at", "completed_at", "status", "search_query", "total_businesses",
                     "total_reviews", dround(secs.cast("double") / 60, 2).alias("duration_minutes"))
            .orderBy(F.desc_nulls_first("created_at")))
