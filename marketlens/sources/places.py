"""Scraped place records: the ingest side.

Upstream delivers one JSON object per place with its reviews nested in a
``reviews`` array.  We derive such items from the market fixture (so the
work grows with the driver tables), land them as JSON lines, and ingest them
back with an explicit schema — never ``inferSchema``.

Item shape: a place can arrive in several items, each carrying a bounded
page of its reviews (``REVIEW_PAGE`` reviews, keyed by review id range), the
way a scraping API pages a busy place.  Building items therefore never
collects one place's reviews into a single unbounded array.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, MapType, StringType, StructField,
                               StructType)

from marketlens.session import checkpoint_dir
from marketlens.sources import warehouse as fx

REVIEW_PAGE = 1000
#: Landed lines are compressed: their keys, and a place's fields in each of its items, repeat.  Such a file is read by one
#: task, so it is bounded by its lines (about 1.5 KB each before compression, with a review or two).
LANDED_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "25000"}

REVIEW_ITEM = StructType([
    StructField("reviewerId", StringType()), StructField("reviewerUrl", StringType()),
    StructField("name", StringType()), StructField("reviewerNumberOfReviews", IntegerType()),
    StructField("isLocalGuide", BooleanType()), StructField("stars", IntegerType()),
    StructField("text", StringType()), StructField("textTranslated", StringType()),
    StructField("publishAt", StringType()), StructField("publishedAtDate", StringType()),
    StructField("likesCount", IntegerType()), StructField("reviewId", StringType()),
    StructField("reviewUrl", StringType()), StructField("reviewImageUrls", ArrayType(StringType())),
    StructField("responseFromOwnerDate", StringType()), StructField("responseFromOwnerText", StringType()),
])
DISTRIBUTION = StructType([StructField(k, IntegerType()) for k in
                           ("oneStar", "twoStar", "threeStar", "fourStar", "fiveStar")])
HOURS = MapType(StringType(), ArrayType(StructType([StructField("hour", IntegerType()), StructField("occupancyPercent", IntegerType())])))
LOCATION = StructType([StructField("lat", DoubleType()), StructField("lng", DoubleType())])
PLACE = StructType([
    StructField("title", StringType()), StructField("categoryName", StringType()),
    StructField("searchString", StringType()), StructField("url", StringType()),
    StructField("city", StringType()), StructField("state", StringType()),
    StructField("street", StringType()), StructField("postalCode", StringType()),
    StructField("countryCode", StringType()), StructField("plusCode", StringType()),
    StructField("isAdvertisement", BooleanType()), StructField("rank", IntegerType()),
    StructField("searchPageUrl", StringType()), StructField("totalScore", DoubleType()),
    StructField("reviewsCount", IntegerType()), StructField("reviewsDistribution", DISTRIBUTION),
    StructField("website", StringType()), StructField("phone", StringType()),
    StructField("phoneUnformatted", StringType()), StructField("email", StringType()),
    StructField("claimThisBusiness", BooleanType()), StructField("menu", StringType()),
    StructField("temporarilyClosed", BooleanType()), StructField("permanentlyClosed", BooleanType()),
    StructField("facebookPages", StringType()), StructField("instagrams", StringType()),
    StructField("twitters", StringType()), StructField("linkedIns", StringType()),
    StructField("pinterests", StringType()), StructField("youtubes", StringType()),
    StructField("popularTimesHistogram", HOURS),
    StructField("tags", ArrayType(StringType())),
    StructField("gadId", StringType()), StructField("placeId", StringType()),
    StructField("cid", StringType()), StructField("dataId", StringType()),
    StructField("price", StringType()), StructField("location", LOCATION),
    StructField("scrapedAt", StringType()),
    StructField("reviews", ArrayType(REVIEW_ITEM)),
])
SCRAPE_TIME = "2025-10-01T06:00:00"


def place_url(id_col: Column) -> Column:
    return F.concat(F.lit("https://maps.example.com/?cid="), id_col.cast("string"))


def _review_item(r: Column) -> Column:
    """The item's review of a row of ``business_reviews``."""
    rid = r["id"]
    return F.struct(
        F.concat(F.lit("u"), (rid % 997).cast("string")).alias("reviewerId"),
        F.lit(None).cast("string").alias("reviewerUrl"),
        r["reviewer_name"].alias("name"),
        (rid % 50).cast("int").alias("reviewerNumberOfReviews"),
        (rid % 5 == 0).alias("isLocalGuide"),
        r["stars"].alias("stars"),
        r["review_text"].alias("text"),
        F.lit(None).cast("string").alias("textTranslated"),
        F.lit(None).cast("string").alias("publishAt"),
        F.concat(r["published_at"].cast("string"), F.lit("T12:00:00.000Z")).alias("publishedAtDate"),
        (rid % 7).cast("int").alias("likesCount"),
        F.concat(F.lit("r"), rid.cast("string")).alias("reviewId"),
        F.lit(None).cast("string").alias("reviewUrl"),
        F.array().cast("array<string>").alias("reviewImageUrls"),
        F.lit(None).cast("string").alias("responseFromOwnerDate"),
        F.lit(None).cast("string").alias("responseFromOwnerText"),
    )


def place_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upstream items derived from the fixture: one per (place, review page).

    Only the reviews' own columns and the businesses' few are moved; the
    items' many fields are made of them behind the join.
    """
    doc = F.from_json("business_data", "struct<social:struct<instagrams:string,facebookPages:string>,"
                      "rating:struct<reviewsDistribution:struct<oneStar:int,twoStar:int,threeStar:int,"
                      "fourStar:int,fiveStar:int>>,tags:array<string>>")
    b = fx.businesses(spark, sf_dir).select("id", "business_name", "category", "execution_id", "city", "rating", "review_count", "website", "phone", doc.alias("doc"))
    r = fx.reviews(spark, sf_dir)
    pages = (r.groupBy("business_id", F.floor(F.col("id") / REVIEW_PAGE).alias("page"))
             .agg(F.collect_list(F.struct("id", "reviewer_name", "stars", "review_text", "published_at")).alias("own_reviews")))   # ≤ REVIEW_PAGE per list
    k, doc = F.col("id"), F.col("doc")
    page = F.coalesce("page", F.lit(0).cast("bigint"))
    scraped = F.date_format(F.timestamp_add("SECOND", page, F.lit(SCRAPE_TIME).cast("timestamp_ntz")),
                            "yyyy-MM-dd'T'HH:mm:ss")
    items = b.join(pages, b["id"] == pages["business_id"], "left")
    return items.select(
        F.col("business_name").alias("title"), F.col("category").alias("categoryName"),
        F.concat(F.lit("query_"), (F.col("execution_id") % 5).cast("string")).alias("searchString"),
        place_url(k).alias("url"), "city", F.lit(None).cast("string").alias("state"),
        F.concat((k % 9000 + 100).cast("string"), F.lit(" Main St")).alias("street"),
        F.lpad((k % 99999).cast("string"), 5, "0").alias("postalCode"),
        F.lit("US").alias("countryCode"), F.lit(None).cast("string").alias("plusCode"),
        F.lit(False).alias("isAdvertisement"), (k % 20 + 1).cast("int").alias("rank"),
        F.lit(None).cast("string").alias("searchPageUrl"),
        F.col("rating").cast("double").alias("totalScore"),
        F.coalesce(F.col("review_count"), F.lit(0)).alias("reviewsCount"),
        doc["rating"]["reviewsDistribution"].alias("reviewsDistribution"),
        "website", "phone", F.regexp_replace("phone", "-", "").alias("phoneUnformatted"),
        F.lit(None).cast("string").alias("email"), F.lit(False).alias("claimThisBusiness"),
        F.lit(None).cast("string").alias("menu"), F.lit(False).alias("temporarilyClosed"),
        (k % 97 == 0).alias("permanentlyClosed"),
        doc["social"]["facebookPages"].alias("facebookPages"), doc["social"]["instagrams"].alias("instagrams"),
        *[F.when(k % n == 0, F.concat(F.lit(f"https://{site}.com/b"), k.cast("string"))).alias(c)
          for c, site, n in (("twitters", "twitter", 6), ("linkedIns", "linkedin", 8), ("pinterests", "pinterest", 9), ("youtubes", "youtube", 10))],
        F.when(k % 5 == 0, F.create_map(F.lit("Mo"), F.array(*[
            F.struct(F.lit(h).alias("hour"), ((k + h) % 100).cast("int").alias("occupancyPercent")) for h in (9, 17)]))).cast(HOURS).alias("popularTimesHistogram"),
        F.when(k % 9 != 4, doc["tags"]).alias("tags"),
        F.lit(None).cast("string").alias("gadId"), F.concat(F.lit("place_"), k.cast("string")).alias("placeId"),
        k.cast("string").alias("cid"), F.lit(None).cast("string").alias("dataId"),
        F.lit(None).cast("string").alias("price"),
        F.struct((F.lit(33.0) + (k % 1000) / 1000.0).alias("lat"),
                 (F.lit(-112.0) - (k % 1000) / 1000.0).alias("lng")).alias("location"),
        scraped.alias("scrapedAt"),
        F.coalesce(F.transform("own_reviews", _review_item), F.array().cast(ArrayType(REVIEW_ITEM))).alias("reviews"),
    ).select(*[f.name for f in PLACE.fields])


def land_places(items: DataFrame, path: str) -> str:
    """Write items as JSON lines (the landing zone)."""
    items.write.mode("overwrite").options(**LANDED_FILES).json(path)
    return path


def landing_path(spark: SparkSession, name: str = "places") -> str:
    return os.path.join(checkpoint_dir(spark), "landing", f"{name}-{uuid.uuid4().hex[:12]}")


def read_places(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Read landed place items with the declared schema (``limit`` = the API's cap)."""
    df = spark.read.schema(PLACE).option("mode", "PERMISSIVE").json(path)
    return df.limit(limit) if limit else df


# ---------------------------------------------------------------------------
# S2–S8 projections (JS falsy → NULL), S9 merge, S10 combine
# ---------------------------------------------------------------------------
def _falsy_str(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _falsy_num(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def overview(items: DataFrame) -> Column:
    s = lambda c: _falsy_str(F.col(c))
    return F.struct(
        s("title").alias("title"), s("categoryName").alias("category"), s("searchString").alias("searchString"),
        s("url").alias("url"), s("city").alias("city"), s("state").alias("state"), s("street").alias("street"),
        s("postalCode").alias("postalCode"), s("countryCode").alias("countryCode"),
        s("plusCode").alias("plusCode"), F.coalesce("isAdvertisement", F.lit(False)).alias("isAdvertisement"),
        _falsy_num(F.col("rank")).alias("rank"), s("searchPageUrl").alias("searchPageUrl"),
        F.coalesce("temporarilyClosed", F.lit(False)).alias("temporarilyClosed"),
        F.coalesce("permanentlyClosed", F.lit(False)).alias("permanentlyClosed"),
    )


def contact(items: DataFrame) -> Column:
    s = lambda c: _falsy_str(F.col(c))
    return F.struct(s("phone").alias("phone"), s("phoneUnformatted").alias("phoneUnformatted"),
                    s("website").alias("website"), s("email").alias("email"),
                    F.coalesce("claimThisBusiness", F.lit(False)).alias("claimThisBusiness"),
                    s("menu").alias("menu"))


def social(items: DataFrame) -> Column:
    return F.struct(*[_falsy_str(F.col(c)).alias(c) for c in
                      ("facebookPages", "instagrams", "twitters", "linkedIns", "pinterests", "youtubes")])


def rating(items: DataFrame) -> Column:
    return F.struct(_falsy_num(F.col("totalScore")).alias("totalScore"),
                    _falsy_num(F.col("reviewsCount")).alias("reviewsCount"),
                    F.col("reviewsDistribution").alias("reviewsDistribution"))


def lead(items: DataFrame) -> Column:
    return F.struct(*[_falsy_str(F.col(c)).alias(c) for c in ("gadId", "placeId", "cid", "dataId", "price")],
                    F.col("location").alias("location"))


def place_key(items: DataFrame) -> Column:
    """Deterministic business key: url, else placeId, else a hash of name and address."""
    addr = F.sha2(F.concat_ws("|", F.col("title"), F.col("street"), F.col("postalCode")), 256)
    return F.coalesce(_falsy_str(F.col("url")), _falsy_str(F.col("placeId")), F.concat(F.lit("h_"), addr))


def by_place(items: DataFrame) -> DataFrame:
    """The items dealt by their business, for a fold of each: only the fields that are used move, and no task sorts what it read."""
    return items.repartition(place_key(items))


def combine_business(items: DataFrame, *more: str) -> DataFrame:
    """S9 + S10: all seven dimensions from the same row, one JSON document.

    Columns: apify_place_id, business_name, search_string, scraped_at,
    business_data plus the generated columns (and ``more`` of the items).
    """
    doc = F.to_json(F.struct(
        overview(items).alias("overview"), contact(items).alias("contact"), social(items).alias("social"),
        rating(items).alias("rating"),
        F.struct("popularTimesHistogram").alias("popular_times"),
        F.col("tags").alias("tags"),
        lead(items).alias("lead_enrichment"),
        F.col("scrapedAt").alias("scraped_at"),
    ))
    return items.select(
        place_key(items).alias("apify_place_id"),
        F.coalesce(_falsy_str(F.col("title")), F.lit("Unknown")).alias("business_name"),
        _falsy_str(F.col("searchString")).alias("search_string"),
        F.col("scrapedAt").cast("timestamp_ntz").alias("scraped_at"),
        _falsy_str(F.col("categoryName")).alias("category"),
        _falsy_str(F.col("city")).alias("city"),
        F.col("totalScore").cast("decimal(3,1)").alias("rating"),
        _falsy_num(F.col("reviewsCount")).alias("review_count"),
        _falsy_str(F.col("website")).alias("website"),
        _falsy_str(F.col("phone")).alias("phone"),
        doc.alias("business_data"),
        *more,
    )


# ---------------------------------------------------------------------------
# S12 flatten reviews, S13 resolve business
# ---------------------------------------------------------------------------
def flatten_reviews(items: DataFrame, *more: str) -> DataFrame:
    """One row per nested review (items without reviews emit nothing), with ``more`` columns of the item."""
    e = items.select(place_key(items).alias("apify_place_id"), F.col("title").alias("place_name"),
                     F.col("url").alias("place_url"), F.explode("reviews").alias("r"), *more)
    r = F.col("r")
    doc = F.to_json(F.struct(
        F.col("place_name").alias("placeName"), r["reviewerId"].alias("reviewerId"),
        r["reviewerUrl"].alias("reviewerUrl"), r["name"].alias("reviewerName"),
        r["reviewerNumberOfReviews"].alias("reviewerNumberOfReviews"), r["isLocalGuide"].alias("isLocalGuide"),
        r["stars"].alias("stars"), r["text"].alias("text"), r["textTranslated"].alias("textTranslated"),
        r["publishAt"].alias("publishAt"), r["publishedAtDate"].alias("publishedAtDate"),
        r["likesCount"].alias("likesCount"), r["reviewId"].alias("reviewId"), r["reviewUrl"].alias("reviewUrl"),
        r["reviewImageUrls"].alias("reviewImageUrls"), r["responseFromOwnerDate"].alias("responseFromOwnerDate"),
        r["responseFromOwnerText"].alias("responseFromOwnerText")))
    return e.select("apify_place_id", "place_name", "place_url", r["reviewId"].alias("review_id"),
                    doc.alias("review_data"), *more)


def with_business_id(flat_reviews: DataFrame, businesses: DataFrame) -> DataFrame:
    """Flattened reviews with the id of their business (NULL: unresolved).

    Match on the place key first; else on the place url (stored in the
    document); else on the name only when exactly one business has it.
    Resolution runs on the *distinct place descriptors* (at most one row per
    place, deduplicated map-side), with equi-joins and a coalesce — never an
    OR join — and the result is joined back to the reviews once.
    """
    desc_cols = ["apify_place_id", "place_url", "place_name"]
    places = flat_reviews.select(*desc_cols).distinct()
    keyed = businesses.groupBy("apify_place_id").agg(F.min("id").alias("_kid"))      # one hit per key and per url
    url = F.get_json_object("business_data", "$.overview.url") if "business_data" in businesses.columns else F.lit(None).cast("string")
    by_url = (businesses.select(F.col("id"), url.alias("place_url")).filter(F.col("place_url").isNotNull())
              .groupBy("place_url").agg(F.min("id").alias("_uid")))
    names = businesses.groupBy(F.col("business_name").alias("place_name")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("id").alias("_nid")).filter(F.col("_n") == 1).drop("_n")
    resolved = (places.join(keyed, "apify_place_id", "left")
                .join(by_url, "place_url", "left")
                .join(names, "place_name", "left")
                .select(*desc_cols, F.coalesce("_kid", "_uid", "_nid").alias("business_id")))
    r = resolved.alias("p")
    f = flat_reviews.alias("f")
    return f.join(r, [F.col(f"f.{c}").eqNullSafe(F.col(f"p.{c}")) for c in desc_cols], "left") \
            .select("f.*", F.col("p.business_id"))


def resolve_business(flat_reviews: DataFrame, businesses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`with_business_id` → (resolved, unresolved)."""
    j = with_business_id(flat_reviews, businesses)
    return j.filter(F.col("business_id").isNotNull()), j.filter(F.col("business_id").isNull())


__all__ = ["PLACE", "REVIEW_ITEM", "place_items", "land_places", "read_places", "combine_business",
           "flatten_reviews", "resolve_business"]

