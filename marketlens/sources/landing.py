"""The landed items as a table that only grows, with the file each row came from.

``<base>/items`` holds every place item as it was parsed (reviews nested) and
every line that could not be parsed, with its text; ``<base>/files`` holds a
row for each landing file taken: its path, its time of change, and the load
that stored it.  A file counts as taken by these rows alone, so neither a new
checkpoint nor another landing folder loses or repeats a row: a batch skips
the files that are in ``files`` and writes the rest under a load of its own,
and a load counts once its files are noted.

Businesses and reviews are folds of these rows: of a business the newest
item, of a review its first delivery.  They do not depend on how files were
dealt to batches.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from marketlens.functions.scalar import ntz_lit
from marketlens.operators import quality as Q
from marketlens.operators.broadcast import bounded_broadcast
from marketlens.session import materialize
from marketlens.sources import places as P

#: The text of a line that is no place item.
CORRUPT = "_corrupt_record"
LANDED = StructType([*P.PLACE.fields, StructField(CORRUPT, StringType())])
FILES = StructType([StructField("source_file", StringType()), StructField("source_time", TimestampType()), StructField("rows", LongType()),
                    StructField("taken_at", TimestampNTZType()), StructField("load", StringType())])
#: Noted files are broadcast up to so many, counted first.
BROADCAST_FILES = 1_000_000
SOURCE = ["source_file", "source_time"]


def read_landed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Place items of a landing folder with their file, and unparsable lines in ``_corrupt_record``.

    ``multi_line`` reads pretty-printed objects and arrays; what is wrong in
    such a file is reported for the whole file, with its text.
    """
    return with_source(spark.read.schema(LANDED).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line).json(path))


def with_source(items: DataFrame) -> DataFrame:
    return items.select(*LANDED.names, F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("source_time"))


def accepted_items(items: DataFrame) -> DataFrame:
    """Items that were parsed whole."""
    return items.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_lines(items: DataFrame) -> DataFrame:
    """Lines that were not, with their file and text.

    ``items`` must be stored: Spark does not read a JSON source for its
    unparsable lines alone.
    """
    return items.where(F.col(CORRUPT).isNotNull()).select("source_file", F.col(CORRUPT).alias("line"))


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or no rows before it is first written."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def taken_files(spark: SparkSession, base: str) -> DataFrame:
    """The landing files that count, each with its rows and load."""
    return _read(spark, f"{base}/files", FILES)


def take(items: DataFrame, base: str, now: _dt.datetime) -> int:
    """Store the rows of files not yet taken; returns how many files these are.

    The rows are written first, under a load of their own, and the files are
    noted after that: what a failed attempt wrote belongs to no noted load
    and is never read.
    """
    spark = items.sparkSession
    load = uuid.uuid4().hex
    known = bounded_broadcast(taken_files(spark, base).select(*SOURCE), BROADCAST_FILES)
    items.join(known, SOURCE, "left_anti").write.parquet(f"{base}/items/load={load}")      # a partition of its own, without a sort by it
    written = _read(spark, f"{base}/items", _items_schema(items)).where(F.col("load") == load)
    files = written.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("rows")).select(*SOURCE, "rows", ntz_lit(now).alias("taken_at"), F.lit(load).alias("load"))
    noted = files.count()
    if noted:
        files.coalesce(1).write.mode("append").parquet(f"{base}/files")      # one file: noted whole or not at all
    return noted


def _items_schema(items: DataFrame) -> StructType:
    return StructType([*items.schema.fields, StructField("load", StringType())])


def stored_items(spark: SparkSession, base: str) -> DataFrame:
    """All rows of noted loads, with the time their file was taken."""
    schema = StructType([*LANDED.fields, StructField("source_file", StringType()), StructField("source_time", TimestampType()), StructField("load", StringType())])
    files = bounded_broadcast(taken_files(spark, base).select(*SOURCE, "load", "taken_at"), BROADCAST_FILES)
    return _read(spark, f"{base}/items", schema).join(files, [*SOURCE, "load"])


def stored_businesses(spark: SparkSession, base: str, existing: DataFrame) -> DataFrame:
    """``existing`` with the stored items upserted: the newest item of a place, created when first taken, updated when last taken.

    One aggregation over the items, dealt by place, then the same anti and
    semi joins as any upsert.  Items of one time are told apart by their row.
    """
    names = existing.columns
    combined = P.combine_business(P.by_place(accepted_items(stored_items(spark, base))), "taken_at")
    payload = [c for c in combined.columns if c in names and c not in ("id", "apify_place_id", "created_at", "updated_at")]
    newest = combined.groupBy("apify_place_id").agg(
        F.max(F.struct("scraped_at", "taken_at", *payload)).alias("_p"), F.min("taken_at").alias("created_at"), F.max("taken_at").alias("updated_at"))
    fresh = newest.select("apify_place_id", *[F.col("_p")[c].alias(c) for c in payload], "created_at", "updated_at")
    keys = fresh.select("apify_place_id")
    untouched = existing.join(keys, "apify_place_id", "left_anti")
    matched = existing.join(keys, "apify_place_id", "left_semi").select("apify_place_id", *[F.col(c).alias(f"_old_{c}") for c in names if c != "apify_place_id"])
    joined = fresh.join(matched, "apify_place_id", "left")
    value = {c: F.col(c) if c in payload else F.col(f"_old_{c}") for c in names if c != "apify_place_id"}
    value |= {"apify_place_id": F.col("apify_place_id"), "updated_at": F.col("updated_at")}
    if "id" in names:
        value["id"] = F.coalesce("_old_id", F.xxhash64("apify_place_id"))
    if "created_at" in names:
        value["created_at"] = F.coalesce("_old_created_at", "created_at")
    return untouched.select(*names).unionByName(joined.select(*[value[c].alias(c) for c in names]))


def first_deliveries(spark: SparkSession, base: str) -> DataFrame:
    """The reviews of the stored items, each once: its first delivery (of one load, the least row)."""
    flat = P.flatten_reviews(accepted_items(stored_items(spark, base)), "taken_at")
    row = ["apify_place_id", "place_name", "place_url", "review_data"]
    once = flat.repartition("review_id").groupBy("review_id").agg(F.min(F.struct("taken_at", *row)).alias("_r"))
    return once.select("review_id", *[F.col("_r")[c].alias(c) for c in row])


def extracted_reviews(flat: DataFrame) -> DataFrame:
    """Flattened reviews with their extracted fields in place of the document, and what their business is resolved by."""
    raw = flat.withColumnRenamed("review_id", "id").withColumn("business_id", F.lit(None).cast("long"))
    return Q.extract_review_fields(raw, "apify_place_id", "place_name", "place_url").withColumnRenamed("id", "review_id").drop("business_id")


def accepted_and_rejected(reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Extracted reviews with their business: those accepted, and (review_id, reason) of the others, in one pass each."""
    known = F.col("business_id").isNotNull()
    good, bad = Q.split(reviews, known & Q.stars_ok(F.col("stars")))
    return good, bad.select("review_id", F.when(known, "stars_range").otherwise("no_business").alias("reason"))


def stored_reviews(spark: SparkSession, base: str, businesses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): reviews with their business and extracted fields; and what was not accepted, with a reason.

    The first deliveries are stored with their extracted fields, as they are read more than once.
    """
    first = materialize(extracted_reviews(first_deliveries(spark, base)), "first-deliveries")
    good, bad = accepted_and_rejected(P.with_business_id(first, businesses))
    lines = rejected_lines(stored_items(spark, base)).select(F.col("line").alias("review_id"), F.lit("corrupt_line").alias("reason"))
    return good.select("review_id", "business_id", "reviewer_name", "stars", "review_text", "published_at"), bad.unionByName(lines)
