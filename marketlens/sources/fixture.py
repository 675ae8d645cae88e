"""Market tables derived from the driver's TPC-H-style tables.

The reference stores scraped places (``businesses``), their reviews
(``business_reviews``) and ingest runs (``market_executions``).  The driver
ships none of those, so we derive them by pure arithmetic on given columns:

* businesses        = customer ⋈ nation ⋈ region   (one row per c_custkey)
* business_reviews  = orders                        (one row per o_orderkey)
* market_executions = nation                        (one row per n_nationkey)

Every column is a deterministic expression, so the work grows with the input
tables and the DuckDB oracle (``marketlens.oracle``) can rebuild identical
rows.  Nothing is collected: these are lazy projections plus one join with a
the small nation⋈region dimension, planned by its size.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the derived fixture (FIXTURES.md part B).
# ---------------------------------------------------------------------------
AS_OF = _dt.date(2025, 10, 1)
BUSINESS_EPOCH = "2025-09-01 00:00:00"
REVIEW_TEMPLATES = (
    "Terrible experience, they showed up late and it was overpriced",
    "Rude staff, no callback, and a hidden fee on the bill",
    "Never available on weekend, had to wait for an appointment",
    "Shoddy repair, broken part, poor quality work",
    "Total ripoff, they charge $450 for a cheap job",
    "Unprofessional and slow response, missed appointment",
    "Closed during an emergency, no 24/7 service",
    "Average service, nothing special, parking is tight",
    "Decent place. Cash only.",
    "Good maintenance visit for my home, reasonable price",
    "Fast and professional installation at a fair price",
    "Excellent quality custom design, worth the thousand dollar quote",
    "Knowledgeable experienced crew, on time, perfect inspection",
    "Our property manager uses them for commercial office maintenance",
    "Friendly family business, upfront estimate and warranty",
)


def _jstr(c: Column) -> Column:
    """JSON string literal for a value without quotes/backslashes; NULL → null."""
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """nation and region, whose joins are left to the planner: it broadcasts them as long as their files are small."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n, r


def business_tag(k: Column) -> Column:
    return (F.when(k % 60 == 0, "Emergency Service")
            .when(k % 60 == 2, "24/7 Access")
            .when(k % 60 == 3, "Installation")
            .when(k % 300 == 10, "Custom Design")
            .when(k % 20 == 4, "AC Repair"))


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``businesses`` relation (its columns and the JSON document)."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n, r = _dims(spark, sf_dir)
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    k = F.col("c_custkey")
    city = (F.when(k % 50 == 49, F.lit(None).cast("string"))
            .when(k % 2 == 0, F.lit("METRO"))
            .when(k % 3 == 0, F.col("r_name"))
            .otherwise(F.col("n_name")))
    rating = (F.lit(1.0).cast("decimal(2,1)") + (k % 41) / F.lit(10.0).cast("decimal(3,1)")).cast("decimal(3,1)")
    review_count = F.when(k % 29 == 0, F.lit(None).cast("int")).otherwise(((k * 37) % 400).cast("int"))
    ks = k.cast("string")
    website = (F.when(k % 5 == 0, F.lit(None).cast("string"))
               .when(k % 5 == 1, F.lit(""))
               .otherwise(F.concat(F.lit("https://b"), ks, F.lit(".example.com"))))
    phone = F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("+1-555-"), ks))
    created_at = F.timestamp_add("MINUTE", k, F.lit(BUSINESS_EPOCH).cast("timestamp_ntz"))

    df = j.select(
        k.alias("id"),
        F.col("c_nationkey").cast("int").alias("execution_id"),
        F.col("c_name").alias("business_name"),
        F.concat(F.lit("https://maps.example.com/?cid="), ks).alias("apify_place_id"),
        F.col("c_mktsegment").alias("category"),
        city.alias("city"),
        rating.alias("rating"),
        review_count.alias("review_count"),
        website.alias("website"),
        phone.alias("phone"),
        business_tag(k).alias("_tag"),
        created_at.alias("created_at"),
    )
    k = F.col("id")
    ks = k.cast("string")
    social = F.concat(
        F.lit('{"instagrams":'),
        F.when(k % 3 == 0, F.concat(F.lit('"https://instagram.com/b'), ks, F.lit('"')))
        .when(k % 3 == 1, F.lit('""')).otherwise(F.lit("null")),
        F.when(k % 4 == 0, F.concat(F.lit(',"facebookPages":"https://facebook.com/b'), ks, F.lit('"')))
        .otherwise(F.lit("")),
        F.lit("}"),
    )
    dist = F.when(k % 10 == 9, F.lit("")).otherwise(F.concat(
        F.lit(',"reviewsDistribution":{"oneStar":'), (k % 7).cast("string"),
        F.lit(',"twoStar":'), (k % 5).cast("string"),
        F.lit(',"threeStar":'), (k % 11).cast("string"),
        F.lit(',"fourStar":'), (k % 13).cast("string"),
        F.lit(',"fiveStar":'), (k % 17).cast("string"),
        F.lit("}")))
    doc = F.concat(
        F.lit('{"overview":{"title":'), _jstr(F.col("business_name")),
        F.lit(',"category":'), _jstr(F.col("category")),
        F.lit(',"city":'), _jstr(F.col("city")),
        F.lit('},"contact":{"phone":'), _jstr(F.col("phone")),
        F.lit(',"website":'), _jstr(F.col("website")),
        F.lit('},"social":'), social,
        F.lit(',"rating":{"totalScore":"'), F.col("rating").cast("string"),
        F.lit('","reviewsCount":'), F.coalesce(F.col("review_count").cast("string"), F.lit("null")),
        dist,
        F.lit('},"tags":'),
        F.when(F.col("_tag").isNull(), F.lit("[]")).otherwise(F.concat(F.lit('["'), F.col("_tag"), F.lit('"]'))),
        F.lit("}"),
    )
    return df.withColumn("business_data", doc).drop("_tag")


def _review_star_seed(oid: Column, bid: Column) -> Column:
    return (oid * 7 + bid * 3) % 5


def reviews(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> DataFrame:
    """The ``business_reviews`` relation: one review per order."""
    return reviews_from_orders(read_table(spark, sf_dir, "orders"), as_of)


def reviews_from_orders(orders: DataFrame, as_of: _dt.date = AS_OF) -> DataFrame:
    """Row-wise review derivation; works on batch and streaming ``orders``."""
    o = orders.select("o_orderkey", "o_custkey")
    oid, bid = F.col("o_orderkey"), F.col("o_custkey")
    s = _review_star_seed(oid, bid)
    stars = F.when(oid % 23 == 0, F.lit(None).cast("int")).otherwise((s + 1).cast("int"))
    t = (F.when(s <= 1, (oid + 5 * bid) % 7)
         .when(s == 2, 7 + oid % 2)
         .otherwise(9 + (oid + 5 * bid) % 6))
    templates = F.array(*[F.lit(x) for x in REVIEW_TEMPLATES])
    text = F.when(oid % 31 == 0, F.lit(None).cast("string")).otherwise(
        F.element_at(templates, (t + 1).cast("int")))
    published = F.date_sub(F.lit(as_of), ((oid * 7919) % 540).cast("int"))
    return o.select(
        oid.alias("id"),
        bid.alias("business_id"),
        F.concat(F.lit("user_"), (oid % 997).cast("string")).alias("reviewer_name"),
        stars.alias("stars"),
        text.alias("review_text"),
        published.alias("published_at"),
    )


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``market_executions`` relation without its derived totals."""
    n = F.col("n_nationkey")
    created = F.lit(BUSINESS_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(n.cast("int"))
    completed = F.when(n % 6 == 5, F.lit(None).cast("timestamp_ntz")).otherwise(
        created + F.make_dt_interval(F.lit(0), F.lit(0), ((7 * n) % 60 + 1).cast("int"), F.lit(0)))
    status = F.when(n % 6 == 5, "running").when(n % 6 == 4, "failed").otherwise("completed")
    return read_table(spark, sf_dir, "nation").select(
        n.cast("bigint").alias("id"),
        created.alias("created_at"),
        completed.alias("completed_at"),
        status.alias("status"),
        F.concat(F.lit("query_"), (n % 5).cast("string")).alias("search_query"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> DataFrame:
    """Reviews as landed JSON documents, with the malformed values of FIXTURES.md B.

    Columns: (id, business_id, review_data).  ``review_data`` carries the
    upstream keys; stars/date are sometimes unparseable so the extraction
    rules (S18) have something to reject.
    """
    return raw_reviews_from(reviews(spark, sf_dir, as_of))


def raw_reviews_from(r: DataFrame) -> DataFrame:
    """``raw_reviews`` of an existing ``business_reviews`` DataFrame."""
    rid = F.col("id")
    stars_json = (F.when(rid % 37 == 0, F.lit('"five"'))
                  .when(rid % 41 == 0, F.lit("99"))
                  .when(rid % 43 == 0, F.lit('"4.5"'))
                  .otherwise(F.coalesce(F.col("stars").cast("string"), F.lit("null"))))
    date_json = F.when(rid % 47 == 0, F.lit('"not-a-date"')).otherwise(
        F.concat(F.lit('"'), F.col("published_at").cast("string"), F.lit('T12:00:00.000Z"')))
    doc = F.concat(
        F.lit('{"reviewId":"r'), rid.cast("string"),
        F.lit('","reviewerName":'), _jstr(F.col("reviewer_name")),
        F.lit(',"stars":'), stars_json,
        F.lit(',"text":'), _jstr(F.col("review_text")),
        F.lit(',"publishedAtDate":'), date_json,
        F.lit("}"),
    )
    return r.select("id", "business_id", doc.alias("review_data"))


# ---------------------------------------------------------------------------
# incoming rows that break rules (for S21-S24, P4, P13)
# ---------------------------------------------------------------------------
def incoming_businesses(b: DataFrame) -> DataFrame:
    """Businesses as a scrape may deliver them: names, runs or documents missing, unknown runs, repeated place keys."""
    k = F.col("id")
    return b.select(
        "id", F.when(k % 101 != 7, F.col("business_name")).alias("business_name"),
        F.when(k % 103 == 5, F.lit(None)).when(k % 107 == 3, F.lit(999)).otherwise(F.col("execution_id")).cast("int").alias("execution_id"),
        F.when(k % 109 != 2, F.col("business_data")).alias("business_data"),
        F.when(k % 113 == 1, F.concat(F.lit("again_"), F.floor(k / 226).cast("string"))).when(k % 127 != 4, F.col("apify_place_id")).alias("apify_place_id"))


def incoming_reviews(r: DataFrame) -> DataFrame:
    """Reviews, some of businesses that do not exist."""
    return r.select("id", F.when(F.col("id") % 89 == 0, -F.col("id")).otherwise(F.col("business_id")).alias("business_id"))


def incoming_executions(e: DataFrame) -> DataFrame:
    """Runs, some with a status that is missing or unknown."""
    k = F.col("id")
    return e.select("id", F.when(k % 7 == 3, F.lit("paused")).when(k % 11 != 4, F.col("status")).alias("status"))


def load_market(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF):
    """(businesses, reviews, executions) for one data directory."""
    return businesses(spark, sf_dir), reviews(spark, sf_dir, as_of), executions(spark, sf_dir)
