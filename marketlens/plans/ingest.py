"""The ingest chain as one flow: a run is opened, places and reviews are taken in under it, and it is closed.

The run's id goes through every projection, so the totals of the closed run
are counts of what it stored.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.plans import views as V
from marketlens.session import materialize
from marketlens.sources import places as P
from marketlens.sources import store as St
from marketlens.sources.landing import accepted_and_rejected, extracted_reviews


@dataclass(frozen=True)
class Ingested:
    """What a run leaves: lazy over what it stored."""

    executions: DataFrame   # with the run, closed
    businesses: DataFrame   # upserted
    reviews: DataFrame      # accepted, with their business
    rejects: DataFrame      # review_id, reason
    totals: DataFrame       # the run's row with its totals


def run_ingest(spark: SparkSession, items: DataFrame, businesses: DataFrame, executions: DataFrame, search_query: str | None, now: _dt.datetime) -> Ingested:
    """Open a run, combine and upsert its places, resolve, extract and validate its reviews, and close it.

    Reviews without a known business, and reviews outside the stars range,
    are rejected with a reason; of a review delivered twice one is kept.
    What later steps read again and again is stored: the newest item of each
    place, the businesses, and the reviews with their extracted fields, which
    alone are moved to be told apart and resolved (not their documents).
    """
    opened = St.open_execution(spark, executions, search_query, now)
    run = opened.agg(F.max("id")).first()[0]                                     # one number
    combined = P.combine_business(P.by_place(items)).withColumn("execution_id", F.lit(run).cast(businesses.schema["execution_id"].dataType))
    incoming = combined.select(*[c for c in combined.columns if c in businesses.columns or c == "scraped_at"])
    newest = materialize(St.dedupe_latest(incoming.filter(F.col("apify_place_id").isNotNull()), "apify_place_id", "scraped_at"), "chain-places")
    stored = materialize(St.upsert_latest(businesses, newest, "apify_place_id", now), "chain-businesses")
    extracted = extracted_reviews(P.flatten_reviews(items))
    once = materialize(extracted.repartition("review_id").dropDuplicates(["review_id"]), "chain-reviews")
    good, rejects = accepted_and_rejected(P.with_business_id(once, stored))
    reviews = good.select("review_id", "business_id", "reviewer_name", "stars", "review_text", "published_at")
    closed = St.close_execution(opened, run, now)
    own = stored.filter(F.col("execution_id") == run)
    totals = V.execution_stats(closed.filter(F.col("id") == run), own, reviews)
    return Ingested(closed, stored, reviews, rejects, totals)
