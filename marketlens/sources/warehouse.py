"""Stored market tables.

In the reference, ``businesses``, ``business_reviews`` and
``market_executions`` are stored tables that every query reads.  Here they
are derived from the driver tables once per (session, data directory,
as_of), written as Parquet into the shared checkpoint folder, and read back
by every query: scans are column-pruned and filtered at the Parquet level,
and the lineage of a query starts at the stored table (a lost executor
re-reads files instead of re-deriving them).  JSON documents are stored as
shredded VARIANT beside their text, so a query reads the fields it names.

Reviews are deliberately *not* bucketed by business: under a hot key (one
business with a third of all reviews) a bucketed scan would hand that third
to a single task, while a plain scan splits evenly and partial aggregation
collapses the hot key map-side.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.jsonops import DOCUMENT
from marketlens.operators import search
from marketlens.session import materialize
from marketlens.sources import fixture as fx
from marketlens.sources.fixture import AS_OF
from marketlens.sources.tables import read_table, table_path

_STORED: dict[tuple, DataFrame] = {}
_LANDED: dict[tuple, str] = {}
#: The driver tables that each stored table is derived from.
_INPUTS = {"businesses": ("customer", "nation", "region"), "event_documents": ("events",), "business_reviews": ("orders",), "market_executions": ("nation",),
           "landed_places": ("customer", "nation", "region", "orders"), "review_postings": ("orders",), "document_postings": ("documents",), "review_facts": ("orders",)}


def _state(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a table's files from another."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getContentSummary(p)
    return size.getLength(), size.getFileCount(), fs.getFileStatus(p).getModificationTime()


def _key(spark: SparkSession, sf_dir: str, name: str, as_of: _dt.date) -> tuple:
    try:
        app = spark.sparkContext.applicationId
        state = tuple(_state(spark, table_path(sf_dir, t)) for t in _INPUTS[name])
    except Exception:  # noqa: BLE001  (Spark Connect has no SparkContext: stored once per session and path)
        app, state = spark.conf.get("spark.app.id", None) or id(spark), ()
    return (app, sf_dir, name, as_of, state)


def _stored(spark: SparkSession, sf_dir: str, name: str, as_of: _dt.date, build) -> DataFrame:
    """The stored table for the present state of its inputs; it is derived anew when they change."""
    k = _key(spark, sf_dir, name, as_of)
    if k not in _STORED:
        _STORED[k] = materialize(build(), f"market-{name}")
    return _STORED[k]


def clear_stored(spark: SparkSession) -> None:
    """Delete every table that this session stored here."""
    app = spark.sparkContext.applicationId
    for k in [k for k in _STORED if k[0] == app]:
        _LANDED.pop(k, None)
        for file in {f.rsplit("/", 1)[0] for f in _STORED.pop(k).inputFiles()}:
            p = spark._jvm.org.apache.hadoop.fs.Path(file)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """Files of even size, as many as the cluster reads at once: sizes are measured while writing (AQE rebalance).

    A source file of one row group is one task however large; what is stored
    from it need not be.
    """
    return df.hint("rebalance")


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business_documents(spark, sf_dir).drop(DOCUMENT)


def business_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored businesses with their document parsed beside its text, as VARIANT (null where the text is no JSON)."""
    return _stored(spark, sf_dir, "businesses", AS_OF,
                   lambda: spread(fx.businesses(spark, sf_dir).withColumn(DOCUMENT, F.try_parse_json("business_data"))))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, props) with the properties parsed once, as VARIANT."""
    return _stored(spark, sf_dir, "event_documents", AS_OF,
                   lambda: spread(read_table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("props"))))


def reviews(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> DataFrame:
    return _stored(spark, sf_dir, "business_reviews", as_of, lambda: spread(fx.reviews(spark, sf_dir, as_of)))


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "market_executions", AS_OF, lambda: fx.executions(spark, sf_dir))


def load_market(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF):
    return businesses(spark, sf_dir), reviews(spark, sf_dir, as_of), executions(spark, sf_dir)


def landed_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place items landed once as JSON lines and read back with the declared schema."""
    from marketlens.sources import places as P

    k = _key(spark, sf_dir, "landed_places", AS_OF)
    if k not in _STORED:
        _LANDED[k] = P.land_places(P.place_items(spark, sf_dir), P.landing_path(spark))
        _STORED[k] = P.read_places(spark, _LANDED[k])
    return _STORED[k]


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of :func:`landed_places` as text."""
    landed_places(spark, sf_dir)
    return spark.read.text(_LANDED[_key(spark, sf_dir, "landed_places", AS_OF)])


def review_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posting table (stem, id, positions) of the reviews' texts."""
    return _stored(spark, sf_dir, "review_postings", AS_OF, lambda: search.postings(reviews(spark, sf_dir), "id", "review_text"))


def document_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posting table of the documents' whole texts."""
    return _stored(spark, sf_dir, "document_postings", AS_OF, lambda: search.postings(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text"))


def review_facts(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> DataFrame:
    """Every counter of the views for each business, by one scan of the reviews."""
    from marketlens.plans.views import review_facts as counters
    return _stored(spark, sf_dir, "review_facts", as_of, lambda: counters(reviews(spark, sf_dir, as_of), as_of))
