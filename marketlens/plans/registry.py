"""Query registry: key → callable(spark, sf_dir) -> DataFrame.

Every entry reads the driver tables (through the derived market tables) so
its work grows with the data; parameters are the defaults documented on
each function.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import jsonops as J
from marketlens.functions import themes as T
from marketlens.operators import quality as Qa
from marketlens.operators import search as S
from marketlens.operators.distinct_rollup import distinct_rollup
from marketlens.operators.session_memory import session_memory
from marketlens.plans import queries as Q
from marketlens.plans.doc_reads import DOC_READS
from marketlens.plans import views as V
from marketlens.sources import fixture as fx
from marketlens.sources import warehouse as W
from marketlens.sources import landing as L
from marketlens.sources import places as P
from marketlens.sources import store as St
from marketlens.sources.tables import read_table
from marketlens.streaming import jobs as SJ

Query = Callable[[SparkSession, str], DataFrame]
NOW = _dt.datetime(2025, 10, 1, 6, 0, 0)


def _b(spark, d):
    return W.businesses(spark, d)


def _r(spark, d):
    return W.reviews(spark, d)


def _e(spark, d):
    return W.executions(spark, d)


def _raw(spark, d):
    return fx.raw_reviews_from(W.reviews(spark, d))


def _bq(fn, **kw):
    return lambda s, d: fn(W.business_documents(s, d), **kw)


def _brq(fn, **kw):
    return lambda s, d: fn(W.business_documents(s, d), _r(s, d), **kw)


def _exec_stats(spark, d):
    b, r, e = W.load_market(spark, d)
    return V.execution_stats(e, b, r)


def _views(spark, d) -> dict[str, DataFrame]:
    b, r = W.business_documents(spark, d), _r(spark, d)
    f = W.review_facts(spark, d)       # one review scan shared by all views
    return {
        "niche_opportunities": V.niche_opportunities(b, ordered=False),
        "customer_pain_points": V.customer_pain_points(b, r, ordered=False, facts=f, texts=False),
        "market_leaders": V.market_leaders(b, r, ordered=False, facts=f),
        "vulnerable_players": V.vulnerable_players(b, r, ordered=False, facts=f),
        "review_velocity_trends": V.review_velocity_trends(b, r, ordered=False, facts=f),
        "niche_service_gaps": V.niche_service_gaps(b, r, ordered=False, facts=f),
        "business_model_opportunities": V.business_model_opportunities(b, r, ordered=False, facts=f),
        "niche_swot_analysis": V.niche_swot_analysis(b, r, ordered=False, facts=f),
    }


# --- filtered view reads (Q24): one per view ------------------------------------
VIEW_FILTERS = {
    "niche_opportunities__score8": ("niche_opportunities", lambda: F.col("opportunity_score") >= 8),
    "customer_pain_points__metro": ("customer_pain_points", lambda: F.col("city") == "METRO"),
    "market_leaders__inc70": ("market_leaders", lambda: F.col("inc_score") >= 70),
    "vulnerable_players__score60": ("vulnerable_players", lambda: F.col("vulnerability_score") >= 60),
    "review_velocity_trends__growth": ("review_velocity_trends", lambda: F.col("momentum_ratio") >= 1.5),
    "niche_service_gaps__critical": ("niche_service_gaps", lambda: F.col("gap_status") == "CRITICAL_GAP"),
    "business_model_opportunities__viability50": ("business_model_opportunities",
                                                  lambda: F.col("newsletter_viability_score") >= 50),
    "niche_swot_analysis__metro_building": ("niche_swot_analysis",
                                            lambda: (F.col("city") == "METRO") & (F.col("category") == "BUILDING")),
}


def _view_filter(key):
    view, pred = VIEW_FILTERS[key]
    return lambda s, d: VIEW_QUERIES[view](s, d).filter(pred())


VIEW_QUERIES: dict[str, Query] = {
    "niche_opportunities": _bq(V.niche_opportunities),
    "customer_pain_points": _brq(V.customer_pain_points),
    "market_leaders": _brq(V.market_leaders),
    "vulnerable_players": _brq(V.vulnerable_players),
    "review_velocity_trends": _brq(V.review_velocity_trends),
    "niche_service_gaps": _brq(V.niche_service_gaps),
    "business_model_opportunities": _brq(V.business_model_opportunities),
    "niche_swot_analysis": _brq(V.niche_swot_analysis),
    "business_summary": _brq(V.business_summary),
    "recent_executions": lambda s, d: V.recent_executions(_e(s, d), _b(s, d), _r(s, d)),
    "execution_stats": _exec_stats,
}

BUSINESS_QUERIES: dict[str, Query] = {
    "biz_by_city": _bq(Q.biz_by_city),
    "high_rated_low_reviews": _bq(Q.high_rated_low_reviews),
    "biz_with_instagram": _bq(Q.biz_with_instagram),
    "category_analysis": _bq(Q.category_analysis),
    "category_city_stats": _bq(Q.category_city_stats),
    "influencer_potential": _bq(Q.influencer_potential),
    "social_gap": _bq(Q.social_gap),
    "city_rating_filter": _bq(Q.city_rating_filter),
    "city_stats": _bq(Q.city_stats),
    "rating_buckets": _bq(Q.rating_buckets),
    "name_prefix_search": _bq(Q.name_prefix_search),
    "null_execution_probe": lambda s, d: Q.null_execution_probe(fx.incoming_businesses(_b(s, d))),
    "busy_categories": _bq(Q.busy_categories),
    "market_gap_labels": _bq(Q.market_gap_labels),
    "first_businesses": _bq(Q.first_businesses),
    "top_categories": _bq(Q.top_categories),
    "worst_shop": _bq(Q.worst_shop),
    "top_players": lambda s, d: V.top_players(
        _b(s, d).filter(F.col("category").isNotNull()), ["category", "city"]),
}

def _search(found) -> Query:
    """Reviews that a search over their posting table finds, with their business."""
    return lambda s, d: S.with_business(_b(s, d), S.matching(_r(s, d), found(W.review_postings(s, d))))


REVIEW_QUERIES: dict[str, Query] = {
    "reviews_with_business": _brq(Q.reviews_with_business),
    "review_keyword_search": _brq(Q.review_keyword_search),
    "reviews_of_business": _brq(Q.reviews_of_business),
    "sentiment_by_category": _brq(Q.sentiment_by_category),
    "sentiment_buckets": lambda s, d: Q.sentiment_buckets(_r(s, d)),
    "complaint_themes": _brq(Q.complaint_themes),
    "complaint_theme_rows": _brq(Q.complaint_theme_rows),
    "worst_shop_complaints": _brq(Q.worst_shop_complaints),
    "success_factors": _brq(Q.success_factors),
    "success_factor_rows": _brq(Q.success_factor_rows),
    "orphan_reviews": lambda s, d: Q.orphan_reviews(_b(s, d), fx.incoming_reviews(_r(s, d))),
    "businesses_with_reviews": _brq(Q.businesses_with_reviews),
    "counts_per_parent": _brq(Q.counts_per_parent),
    "rating_dispersion": _brq(Q.rating_dispersion),
    "topic_complaints_per_business": lambda s, d: Q.topic_complaints_per_business(
        _b(s, d), S.matching(_r(s, d), S.term(W.review_postings(s, d), "parking"))),
    "load_summary": _brq(Q.load_summary),
    "distinct_rollup": lambda s, d: distinct_rollup(
        _r(s, d).select("business_id").join(_b(s, d).select(F.col("id").alias("business_id"), "city", "category"), "business_id"), ["city", "category"], "business_id", "businesses"),
    "fts_term": _search(lambda p: S.term(p, "parking")),
    "fts_boolean": _search(lambda p: S.but_not(S.term(p, "appointment"), S.term(p, "weekend"))),
    "fts_phrase": _search(lambda p: S.phrase(p, "missed", "appointment")),
    "theme_flags": lambda s, d: _r(s, d).select(
        "id", *[c.alias(k) for k, c in T.theme_flag_columns(F.col("review_text"), F.col("stars")).items()]),
    "keyword_mentions": lambda s, d: V.keyword_mentions(_r(s, d)),
    "service_supply": lambda s, d: V.service_supply(_b(s, d)),
    "price_mentions": lambda s, d: _r(s, d).filter(F.col("review_text").rlike(T.HIGH_TICKET_AMOUNT))
    .select("id", "business_id"),
}

RUN_QUERIES: dict[str, Query] = {
    "execution_trends": lambda s, d: Q.execution_trends(_e(s, d), _b(s, d)),
    "executions_last_7d": lambda s, d: Q.executions_last_7d(_e(s, d)),
    "latest_runs": lambda s, d: Q.latest_runs(_e(s, d), _b(s, d), _r(s, d)),
    "run_review_rows": lambda s, d: Q.run_review_rows(_e(s, d), _b(s, d), _r(s, d)),
    "run_totals_check": lambda s, d: Q.run_totals_check(_exec_stats(s, d), _b(s, d), _r(s, d)),
}


def _cols(view: str, *cols: str) -> Query:
    """A view narrowed to some columns; Catalyst prunes the work they don't need."""
    return lambda s, d: VIEW_QUERIES[view](s, d).select(*cols)


def _pain_cols(*cols: str) -> Query:
    return lambda s, d: V.customer_pain_points(_b(s, d), _r(s, d), texts=False).select(*cols)


PART_QUERIES: dict[str, Query] = {
    "inc_score": _cols("market_leaders", "id", "inc_score", "market_position"),                 # F8
    "rating_consistency": _cols("market_leaders", "id", "rating_variance"),                     # F7
    "pain_theme_counts": _pain_cols( "category", "city", "total_complaints",  # A5
                               *[f"{k}_complaints" for k in T.PAIN_THEMES]),
    "pain_pct": _pain_cols( "category", "city",                               # F10
                      *[f"{k}_pct" for k in T.PAIN_THEMES]),
    "sample_complaints": _brq(V.complaint_snippets),  # A8
    "sample_complaint_pieces": _brq(V.complaint_pieces, piece=2000),
    "positioning": _cols("niche_service_gaps", "category", "city", "specialty_type",            # F3
                         "positioning_strategy"),
    "strength_list": _cols("niche_swot_analysis", "category", "city", "strength_list",          # F16
                           "weakness_list"),
}


def _append_reviews(spark, d):
    """Validate the extracted batch, append accepted rows, read the table back."""
    from marketlens.session import scratch_path
    ext = Qa.extract_review_fields(_raw(spark, d)).select("id", "business_id", "reviewer_name", "stars",
                                                           "review_text", "published_at")
    path = scratch_path(spark, "business_reviews_append")
    St.append_reviews(ext, path)
    return spark.read.parquet(path)


def _observed_warnings(spark, d):
    """S19 as S14 writes: the counts observed in the writing pass, as rows."""
    from marketlens.session import scratch_path
    _, counts, _ = St.append_observed(Qa.extract_review_fields(_raw(spark, d)), scratch_path(spark, "reviews_observed"))
    return spark.createDataFrame(list(counts.items()), "rule string, value long")


def _doc_read(key: str) -> Query:
    view, pred, cols, order, limit = DOC_READS[key]

    def q(s, d):
        df = VIEW_QUERIES[view](s, d).filter(F.expr(pred))
        if limit:
            df = df.orderBy(*[F.desc_nulls_last(c) if o == "desc" else F.asc_nulls_first(c) for c, o in order])
            df = df.limit(limit)
        return df.select(*cols)
    return q


def _facts_query(fn) -> Query:
    """A query over several views, which share the stored counters of each business."""
    return lambda s, d: fn(W.business_documents(s, d), _r(s, d), facts=W.review_facts(s, d))


COMPOSITE_QUERIES: dict[str, Query] = {
    **{k: _doc_read(k) for k in DOC_READS},
    "view_row_counts": lambda s, d: Q.view_row_counts(_views(s, d)),
    "score_ranges": _facts_query(Q.score_ranges),
    "market_report": _brq(Q.market_report),
    "market_entry": _facts_query(Q.market_entry),
    "competitive_intel": _facts_query(Q.competitive_intel),
    "model_validation": _brq(Q.model_validation),
    "product_development": _facts_query(Q.product_development),
    **{k: _view_filter(k) for k in VIEW_FILTERS},
}


def _resolve_branches(spark, d):
    """S13 with places whose key, then url, then name is the one that still matches; every fourth matches nothing."""
    b = _b(spark, d)
    url = F.concat(F.lit("https://old.example.com/"), F.col("id").cast("string"))
    stored = b.select("id", "apify_place_id", "business_name", F.to_json(F.struct(F.struct(url.alias("url")).alias("overview"))).alias("business_data"))
    n = F.regexp_extract("apify_place_id", r"(\d+)$", 1).cast("long") % 4
    flat = P.flatten_reviews(_landed(spark, d))
    gone = F.concat(F.lit("gone_"), F.col("apify_place_id"))
    moved = flat.select(
        "review_id", "review_data",
        F.when(n == 0, F.col("apify_place_id")).otherwise(gone).alias("apify_place_id"),
        F.when(n == 1, F.concat(F.lit("https://old.example.com/"), F.regexp_extract("apify_place_id", r"(\d+)$", 1))).otherwise(gone).alias("place_url"),
        F.when(n <= 2, F.col("place_name")).otherwise(gone).alias("place_name"))
    return P.resolve_business(moved, stored)[0].select("review_id", "business_id")


def _upsert(spark, d):
    """Three quarters of the businesses are stored; all landed places, combined, are upserted, documents included."""
    existing = _b(spark, d).filter(F.col("id") % 4 != 3).select(
        "id", "apify_place_id", "business_name", "review_count", "business_data", "created_at", F.col("created_at").alias("updated_at"))
    incoming = P.combine_business(_landed(spark, d)).select("apify_place_id", "business_name", "review_count", "business_data", "scraped_at")
    return St.upsert(existing, incoming, "apify_place_id", NOW).select(
        "apify_place_id", "business_name", "review_count", "created_at", "updated_at", J.arrow_text(F.col("business_data"), "overview", "url").alias("url"))


def _chain(spark, d):
    """The ingest chain over the landed items, some reviews of which have impossible stars; half of the businesses are stored."""
    from marketlens.plans.ingest import run_ingest
    number = lambda r: F.substring(r["reviewId"], F.lit(2), F.lit(20)).cast("long")
    items = _landed(spark, d).withColumn("reviews", F.transform("reviews", lambda r: r.withField(
        "stars", F.when(number(r) % 41 == 0, F.lit(99)).otherwise(r["stars"]))))
    stored = _b(spark, d).filter(F.col("id") % 2 == 0).select(
        "id", "execution_id", "apify_place_id", "business_name", "review_count", "business_data", "created_at", F.col("created_at").alias("updated_at"))
    return run_ingest(spark, items, stored, _e(spark, d), "chain", NOW)


def _cascade(spark, d):
    b, r, e = W.load_market(spark, d)
    e2, b2, r2 = St.cascade_delete(e, b, r, e.filter(F.col("status") == "failed"))
    return Q.view_row_counts({"market_executions": e2, "businesses": b2, "business_reviews": r2})


def _landed(spark, d):
    return W.landed_places(spark, d)


RUN = 1   # the run whose id the projections carry


def _proj(struct_fn, fields, *more):
    """One S2–S8 projection of the landed items, flattened to columns, under its run."""
    def q(s, d):
        items = _landed(s, d)
        st = struct_fn(items)
        return items.select(F.lit(RUN).alias("execution_id"), P.place_key(items).alias("apify_place_id"), F.col("scrapedAt"),
                            *[st[f].alias(f) for f in fields], *[F.nullif(F.col(c), F.lit("")).alias(c) for c in more])
    return q


def _popular_times(s, d):
    """A row per place, day and hour; places without a histogram keep one row of NULLs."""
    items = _landed(s, d)
    days = items.select(F.lit(RUN).alias("execution_id"), P.place_key(items).alias("apify_place_id"), "title", "url", "scrapedAt",
                        F.explode_outer("popularTimesHistogram").alias("day", "hours"))
    each = days.select("execution_id", "apify_place_id", "title", "url", "scrapedAt", "day", F.explode_outer("hours").alias("h"))
    return each.select("execution_id", "apify_place_id", "title", "url", "scrapedAt", "day", F.col("h.hour").alias("hour"), F.col("h.occupancyPercent").alias("occupancy"))


INGEST_QUERIES: dict[str, Query] = {
    "ingest_popular_times": _popular_times,
    "append_reviews": _append_reviews,
    "append_warnings": _observed_warnings,
    "ingest_overview": _proj(P.overview, ["title", "category", "searchString", "url", "city", "state", "street", "postalCode", "countryCode",
                                          "plusCode", "isAdvertisement", "rank", "searchPageUrl", "temporarilyClosed", "permanentlyClosed"],
                             "website", "phone"),
    "ingest_contact": _proj(P.contact, ["phone", "phoneUnformatted", "website", "email", "claimThisBusiness", "menu"], "title", "url"),
    "ingest_social": _proj(P.social, ["facebookPages", "instagrams", "twitters", "linkedIns", "pinterests", "youtubes"], "title", "url"),
    "ingest_rating": _proj(lambda items: F.struct(
        P.rating(items)["totalScore"].alias("totalScore"), P.rating(items)["reviewsCount"].alias("reviewsCount"),
        *[F.col(f"reviewsDistribution.{k}").alias(k) for k in ("oneStar", "twoStar", "threeStar", "fourStar", "fiveStar")]),
        ["totalScore", "reviewsCount", "oneStar", "twoStar", "threeStar", "fourStar", "fiveStar"], "title", "url"),
    "ingest_tags": lambda s, d: _landed(s, d).select(
        F.lit(RUN).alias("execution_id"), P.place_key(_landed(s, d)).alias("apify_place_id"), "scrapedAt", "title", "url", "tags"),
    "ingest_lead": lambda s, d: _landed(s, d).select(
        F.lit(RUN).alias("execution_id"), P.place_key(_landed(s, d)).alias("apify_place_id"), "scrapedAt", "title", "url",
        "gadId", "placeId", "cid", "dataId", "price", "totalScore", "reviewsCount",
        F.round("location.lat", 6).alias("lat"), F.round("location.lng", 6).alias("lng")),
    "merge_dimensions": lambda s, d: P.combine_business(_landed(s, d)),
    "ingest_places": lambda s, d: _landed(s, d).select(
        "placeId", "title", "totalScore", "scrapedAt", F.size("reviews").cast("bigint").alias("n_reviews")),
    "combine_business": lambda s, d: St.dedupe_latest(
        P.combine_business(_landed(s, d)), "apify_place_id", "scraped_at").select(
        "apify_place_id", "business_name", "category", "city", "rating", "review_count", "website", "phone"),
    "flatten_reviews": lambda s, d: P.flatten_reviews(_landed(s, d)).select(
        "apify_place_id", "review_id",
        Qa.lenient_int(F.get_json_object("review_data", "$.stars")).alias("stars"),
        Qa.lenient_date(F.get_json_object("review_data", "$.publishedAtDate")).alias("published_at")),
    "resolve_business": lambda s, d: P.resolve_business(
        P.flatten_reviews(_landed(s, d)), _b(s, d))[0].select("review_id", "business_id"),
    "resolve_business_branches": _resolve_branches,
    "upsert_businesses": _upsert,
    "upsert_businesses_stored": lambda s, d: _upsert_stored(s, d),
    "cascade_delete_stored": lambda s, d: _cascade_stored(s, d),
    "delete_by_query_stored": lambda s, d: _delete_stored(s, d),
    "ingest_rejected_lines": lambda s, d: _rejected_lines(s, d),
    "ingest_accepted_places": lambda s, d: _accepted_places(s, d),
    "open_execution": lambda s, d: St.open_execution(s, _e(s, d), None, NOW),
    "close_execution": lambda s, d: St.close_execution(_e(s, d), 5, NOW),
    "cascade_delete": _cascade,
    "delete_by_query": lambda s, d: St.delete_by_query(_r(s, d), _b(s, d), _e(s, d), "query_0")
    .select("id"),
    "generated_columns": lambda s, d: Qa.generated_columns(W.business_documents(s, d)),
    "extract_review_fields": lambda s, d: Qa.extract_review_fields(_raw(s, d)),
    "validate_stars": lambda s, d: Qa.validate_stars(Qa.extract_review_fields(_raw(s, d))),
    "validate_status": lambda s, d: Qa.validate_status(fx.incoming_executions(_e(s, d))),
    "validate_not_null": lambda s, d: Qa.validate_not_null(fx.incoming_businesses(_b(s, d))),
    "fk_orphans": lambda s, d: Qa.fk_orphans(
        fx.incoming_businesses(_b(s, d)).filter("execution_id IS NOT NULL"), _e(s, d), "execution_id").select("id", "execution_id"),
    "unique_violations": lambda s, d: Qa.unique_violations(fx.incoming_businesses(_b(s, d)), ["apify_place_id"]),
    "dq_rows": lambda s, d: Qa.dq_rows(_raw(s, d)),
    "ingest_chain": lambda s, d: _chain(s, d).totals.select("id", "status", "search_query", "total_businesses", "total_reviews"),
    "ingest_chain_rejects": lambda s, d: _chain(s, d).rejects,
    "dq_report": lambda s, d: Qa.dq_report(W.business_documents(s, d), Qa.extract_review_fields(_raw(s, d))),
}

JSON_QUERIES: dict[str, Query] = {
    "json_paths": lambda s, d: W.event_documents(s, d).select(
        "event_id", J.text_at(F.col("props"), "k").cast("int").alias("k")).filter(F.col("k") >= 90),
    "json_has_key": lambda s, d: W.business_documents(s, d).filter(J.has_key_at(F.col(J.DOCUMENT), "facebookPages", "social"))
    .select("id"),
    "json_any_all_keys": lambda s, d: W.business_documents(s, d).select(
        "id",
        J.has_any_key_at(F.col(J.DOCUMENT), ["facebookPages", "twitters"], "social").alias("any_key"),
        J.has_all_keys_at(F.col(J.DOCUMENT), ["instagrams", "facebookPages"], "social").alias("all_keys")),
    "json_contains": lambda s, d: W.event_documents(s, d).filter(J.holds(F.col("props"), {"k": 69}))
    .select("event_id"),
}

TEXT_QUERIES: dict[str, Query] = {
    # X1 over whole documents (up to 20k words each)
    "document_term_frequencies": lambda s, d: S.term_frequencies(W.document_postings(s, d)),
    "document_search": lambda s, d: S.matching(
        read_table(s, d, "documents").select("doc_id"), S.either(S.every(S.term(W.document_postings(s, d), "the"), S.term(W.document_postings(s, d), "licensing")),
                                                                 S.term(W.document_postings(s, d), "tokens")), "doc_id"),
}

SESSION_QUERIES: dict[str, Query] = {
    "session_memory": lambda s, d: session_memory(read_table(s, d, "conversations")).select(
        "conv_id", "turn", "role"),
}

def _ingested(spark, d) -> tuple[str, DataFrame]:
    """T1 run to its end over the landed items; the folder of the stored items, and the businesses they make."""
    from marketlens.session import scratch_path
    base = scratch_path(spark, "stream_items")
    empty = spark.createDataFrame([], "id long, apify_place_id string, business_name string, review_count int, "
                                      "business_data string, created_at timestamp_ntz, updated_at timestamp_ntz")
    landing = P.land_places(P.place_items(spark, d), P.landing_path(spark, "stream"))
    SJ.ingest_stream(spark, landing, base, NOW)
    return base, L.stored_businesses(spark, base, empty)


def _ingested_reviews(spark, d):
    """The stored reviews, told by the business's key as the fixture numbers it."""
    from marketlens.session import materialize
    base, stored = _ingested(spark, d)
    stored = materialize(stored.select("id", "apify_place_id", "business_name", "business_data"), "stream-businesses")
    reviews, _ = L.stored_reviews(spark, base, stored)
    own = _b(spark, d).select(F.col("id").alias("own_id"), "apify_place_id")
    return (reviews.join(stored.select(F.col("id").alias("business_id"), "apify_place_id"), "business_id").join(own, "apify_place_id")
            .select("review_id", F.col("own_id").alias("business_id"), "stars", "published_at"))


def _landing_with_errors(spark, d) -> str:
    """The landed items as text, every 25th line cut short and every 40th no JSON at all."""
    lines = W.landed_lines(spark, d)
    n = F.get_json_object("value", "$.cid").cast("long")
    broken = F.when(n % 40 == 0, F.concat(F.lit("scrape failed for "), n)).when(n % 25 == 0, F.concat(F.lit('{"cid": "'), n, F.lit('", "title": '))).otherwise(F.col("value"))
    out = P.landing_path(spark, "broken-lines")
    lines.select(broken.alias("value")).write.options(**P.LANDED_FILES).text(out)
    return out


def _rejected_lines(spark, d):
    """Each line that is no place item, with its text."""
    from marketlens.session import materialize
    broken = L.read_landed(spark, _landing_with_errors(spark, d)).where(F.col(L.CORRUPT).isNotNull())     # parsed with all fields, of which none is stored for nothing
    return L.rejected_lines(materialize(broken, "landed-lines")).select("line")


#: Items that a task writes as pretty-printed arrays, on average, and characters of an array (more only if one item has more): its file is parsed whole.
ARRAY_ITEMS, ARRAY_SIZE = 10_000, 4_000_000


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items of a task as the texts of arrays, each of up to ``ARRAY_SIZE`` characters."""
    array = lambda held: pa.record_batch([pa.array(["[\n" + ",\n".join(held) + "\n]"])], ["value"])
    held: list[str] = []
    size = 0
    for item in (x.as_py() for b in batches for x in b.column(0)):
        if held and size + len(item) > ARRAY_SIZE:
            yield array(held)
            held, size = [], 0
        held.append(item)
        size += len(item)
    if held:
        yield array(held)


def _land_arrays(items: DataFrame, n_items: int, path: str, **options: str) -> None:
    """Write the items, with all their fields and reviews, as pretty-printed arrays, a file each, made where the items lie."""
    one = items.select(F.to_json(F.struct(*P.PLACE.names), {"pretty": "true"}).alias("item")).coalesce(n_items // ARRAY_ITEMS + 1)
    one.mapInArrow(_arrays, "value string").write.options(**options | {"maxRecordsPerFile": "1"}).text(path)


def _whole(items: DataFrame) -> DataFrame:
    """Each item once, with the text of all that was parsed; its reviews in an order of their own.

    Items are told apart by place and time, and only those that share them are moved to be compared.
    """
    from marketlens.session import materialize
    key = F.xxhash64("cid", "scrapedAt")
    again = materialize(items.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key"), "items-again")
    fields = [F.sort_array(c).alias(c) if c == "reviews" else F.col(c) for c in P.PLACE.names]
    whole = items.select("cid", "title", "reviewsCount", F.to_json(F.struct(*fields)).alias("item"), key.alias("_key"))
    if again.isEmpty():
        return whole.drop("_key")
    return whole.join(again, "_key", "left_anti").drop("_key").unionByName(whole.join(again, "_key", "left_semi").drop("_key").distinct())


def _accepted_places(spark, d):
    """The place items of the other lines, and the same items as pretty-printed arrays."""
    lines = L.accepted_items(L.read_landed(spark, _landing_with_errors(spark, d)))
    pretty = P.landing_path(spark, "pretty")
    _land_arrays(_landed(spark, d), _b(spark, d).count() + _r(spark, d).count(), pretty, **P.LANDED_FILES)      # no more items than places and reviews
    whole = L.accepted_items(L.read_landed(spark, pretty, multi_line=True))
    return _whole(lines).withColumn("read_as", F.lit("lines")).unionByName(_whole(whole).withColumn("read_as", F.lit("arrays")))


def _upsert_stored(spark, d):
    """S11 into a bucketed table: as ``upsert_businesses``, the stored side not moved."""
    import uuid
    existing = _b(spark, d).filter(F.col("id") % 4 != 3).select(
        "id", "apify_place_id", "business_name", "review_count", "business_data", "created_at", F.col("created_at").alias("updated_at"))
    incoming = P.combine_business(_landed(spark, d)).select("apify_place_id", "business_name", "review_count", "business_data", "scraped_at")
    table, buckets = f"businesses_{uuid.uuid4().hex[:10]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    St.save_bucketed(existing, table, "apify_place_id", buckets)
    return St.upsert_bucketed(incoming, table, "apify_place_id", NOW, buckets).select(
        "apify_place_id", "business_name", "review_count", "created_at", "updated_at", J.arrow_text(F.col("business_data"), "overview", "url").alias("url"))


def _stored_by_run(spark, d):
    """Businesses and reviews stored by run: their frames and paths."""
    from marketlens.session import scratch_path
    b = _b(spark, d)
    r = _r(spark, d).join(b.select(F.col("id").alias("business_id"), "execution_id"), "business_id")
    paths = [scratch_path(spark, "businesses-by-run"), scratch_path(spark, "reviews-by-run")]
    for frame, path in zip((b, r), paths):
        St.save_by_run(frame, path)
    return b, r, paths


def _cascade_stored(spark, d):
    """S25 on stored tables: the failed runs' partitions go."""
    e = _e(spark, d)
    b, r, paths = _stored_by_run(spark, d)
    St.delete_runs(spark, paths, [x.id for x in e.filter(F.col("status") == "failed").select("id").collect()])    # a few runs
    return Q.view_row_counts({"market_executions": e.filter(~F.col("status").eqNullSafe("failed")), "businesses": St.stored_by_run(spark, paths[0], b),
                              "business_reviews": St.stored_by_run(spark, paths[1], r)})


def _delete_stored(spark, d):
    """S26 on stored tables: the reviews of runs with a query go, other partitions are not touched."""
    b, r, paths = _stored_by_run(spark, d)
    runs = _e(spark, d).filter(F.col("search_query") == "query_0").select(F.col("id").alias("execution_id"))
    doomed = b.join(runs, "execution_id", "left_semi").select("execution_id", F.col("id").alias("business_id"))
    St.delete_rows(St.stored_by_run(spark, paths[1], r), paths[1], doomed, "business_id")
    return St.stored_by_run(spark, paths[1], r).select("id")


STREAM_QUERIES: dict[str, Query] = {
    "stream_ingest_places": lambda s, d: _ingested(s, d)[1].select(
        "apify_place_id", "business_name", "review_count", "created_at", "updated_at"),
    "stream_ingest_reviews": _ingested_reviews,
    "stream_run_counters": SJ.run_counter_stream,
    "stream_velocity_windows": lambda s, d: SJ.velocity_stream(s, d).select("window_start", "event_type", "events"),
    "stream_velocity_90d": lambda s, d: SJ.longer_windows(SJ.velocity_stream(s, d)),
    "stream_velocity_sliding": lambda s, d: SJ.longer_windows(SJ.velocity_stream(s, d), step=1),
    "stream_review_dedupe": SJ.review_stream,
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (VIEW_QUERIES, PART_QUERIES, BUSINESS_QUERIES, REVIEW_QUERIES, RUN_QUERIES, COMPOSITE_QUERIES,
                 INGEST_QUERIES, JSON_QUERIES, TEXT_QUERIES, SESSION_QUERIES, STREAM_QUERIES):
        out.update(part)
    return out
