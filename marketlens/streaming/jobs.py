"""Structured Streaming jobs.

The reference is trigger-driven (row triggers on insert).  Here every job is
a file stream:

* T1 ``ingest_stream``: landed place files become rows of a growing table,
  known by the file they came from (:mod:`marketlens.sources.landing`);
* T2 ``review_stream``: of re-delivered reviews the first is stored; the ids
  seen are streaming state;
* T3 ``run_counter_stream``: review counts per run are streaming state, every
  change of a count is written;
* T4 ``velocity_stream``: events per window and type, likewise.

State is kept by Spark's RocksDB state store.  T2 to T4 write each batch to
its own partition (source, run, batch) of a Parquet folder, overwritten if the
batch is run again; the run is the id of the streaming query, which its
checkpoint keeps over restarts.  By default the checkpoints lie in the folder
itself, one for each source.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.functions.scalar import instant_from_ntz, ntz_from_instant
from marketlens.session import scratch_path
from marketlens.sources import fixture as fx
from marketlens.sources import landing as L
from marketlens.sources.store import exists, is_directory
from marketlens.sources.tables import table_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: RocksDB for state, and the progress of every batch of a call.
STREAM_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.numRecentProgressUpdates": "100000"}


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """Stream one driver table's parquet file(s) with its batch schema, from any file system."""
    path = table_path(sf_dir, name)
    rd = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        rd = rd.option("maxFilesPerTrigger", max_files)
    if is_directory(spark, path):
        return rd.parquet(path)
    folder, _, file = path.rpartition("/")
    return rd.option("pathGlobFilter", file).parquet(folder)


@contextmanager
def stream_conf(spark: SparkSession) -> Iterator[None]:
    """Settings of the queries started here (a query keeps its state's place from its first start)."""
    before = {k: spark.conf.get(k, None) for k in STREAM_CONF}
    for k, v in STREAM_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def run_batches(df: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> list[dict]:
    """Drive a stream to the end of what is there, one call of ``apply`` for each batch; returns the progress of its batches."""
    with stream_conf(df.sparkSession):
        q = df.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return [p if isinstance(p, dict) else p.jsonValue for p in q.recentProgress]


def query_run(spark: SparkSession) -> str:
    """Inside a batch: the id of the streaming query, the same over restarts from its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def source_name(path: str) -> str:
    """A short name of a source folder; each has a query, and so a checkpoint, of its own (Spark's file log belongs to one folder)."""
    return hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]


def checkpoint_of(base: str, path: str) -> str:
    return f"{base}/_checkpoint/{source_name(path)}"


def write_batch(rows: DataFrame, base: str, source: str, number: int) -> None:
    """The rows of one batch as partition (source, run, batch); a batch that is run again replaces what it wrote."""
    told = {"source": F.lit(source), "run": F.lit(query_run(rows.sparkSession)), "batch": F.lit(number).cast("long")}
    rows.withColumns(told).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*told).parquet(f"{base}/rows")


def written(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """What the batches wrote, with ``source``, ``run`` and ``batch``."""
    schema = StructType.fromDDL(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, source string, run string, batch long")
    if not exists(spark, f"{base}/rows"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{base}/rows")


def totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last value written for each key by each source's query, summed over the sources."""
    values = [c for c in rows.columns if c not in (*keys, "source", "run", "batch")]
    last = rows.groupBy("source", *keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    kinds = dict(rows.dtypes)
    return last.groupBy(*keys).agg(*[F.sum(F.col("_v")[c]).cast(kinds[c]).alias(c) for c in values])


def one_run(spark: SparkSession, base: str, source: str) -> None:
    """Totals begin with a query's first batch: a second query over the same source would count its rows twice."""
    if not exists(spark, f"{base}/rows"):
        return
    run = query_run(spark)
    others = spark.read.parquet(f"{base}/rows").where((F.col("source") == source) & (F.col("run") != run)).select("run").limit(1).collect()
    if others:
        raise ValueError(f"{base} holds this source's rows from query {others[0].run}, whose checkpoint this one does not have: go on from that, or name another folder")


def review_stream(spark: SparkSession, sf_dir: str, duplicate_every: int = 19, max_files: int | None = None,
                  base: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """A review stream with re-delivered rows; every review is stored once, its first delivery kept.

    The ids seen are the state of ``dropDuplicates``, one for each review,
    spread over the shuffle partitions.  Called again, the state goes on; a
    query over another folder, or with another checkpoint (a lost one), leaves
    the reviews that other queries stored under ``base`` out of its batches,
    so none is lost or stored twice.
    """
    base = base or scratch_path(spark, "stream_reviews")
    cols = ["id", "business_id", "stars", "published_at"]
    delivered = fx.reviews_from_orders(table_stream(spark, sf_dir, "orders", max_files)).select(*cols)
    times = F.when(F.col("id") % duplicate_every == 0, 2).otherwise(1)
    delivered = delivered.select(*cols, F.explode(F.array_repeat(F.lit(0), times)).alias("_again")).drop("_again")
    schema = delivered.schema

    def apply(batch: DataFrame, number: int) -> None:
        earlier = written(spark, base, schema).where(F.col("run") != query_run(spark)).select("id")
        write_batch(batch.join(earlier, "id", "left_anti").select(*cols), base, source_name(sf_dir), number)

    run_batches(delivered.dropDuplicates(["id"]), apply, checkpoint or checkpoint_of(base, sf_dir))
    return written(spark, base, schema).select(*cols)


def run_counter_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None, base: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Review counts per execution (a stream-static join with the businesses), as state; changed counts are written."""
    base = base or scratch_path(spark, "stream_run_counters")
    r = fx.reviews_from_orders(table_stream(spark, sf_dir, "orders", max_files))
    b = fx.businesses(spark, sf_dir).select(F.col("id").alias("business_id"), "execution_id")
    counts = r.select("business_id").join(b, "business_id").groupBy("execution_id").agg(F.count(F.lit(1)).alias("total_reviews"))

    def apply(batch: DataFrame, number: int) -> None:
        one_run(spark, base, source_name(sf_dir))
        write_batch(batch, base, source_name(sf_dir), number)

    run_batches(counts, apply, checkpoint or checkpoint_of(base, sf_dir), "update")
    return totals(written(spark, base, counts.schema), ["execution_id"])


def velocity_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None, base: str | None = None, checkpoint: str | None = None,
                    length: str = "1 day", step: str | None = None, late: str | None = None) -> DataFrame:
    """T4: events per window and type (``window_start, event_type, events, value_sum``) as state; changed windows are written.

    Windows tumble, or slide by ``step``.  Event times are read as UTC, so
    windows do not move with the session's time zone; rows without a time
    belong to no window.  Without ``late`` no event is too late, and the
    state has a row for each window and type.  With it (a delay), windows
    that ended that long before the latest event are closed and leave the
    state; events that the batch before already had closed windows for are
    dropped, and their number is told by :func:`late_events`.
    """
    base = base or scratch_path(spark, "stream_velocity")
    ev = table_stream(spark, sf_dir, "events", max_files).withColumn("event_time", instant_from_ntz(F.col("ts"))).where(F.col("event_time").isNotNull())
    if late:
        ev = ev.withWatermark("event_time", late)
    windows = (ev.groupBy(F.window("event_time", length, step).alias("w"), "event_type")
               .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(38,6)")).cast("decimal(38,6)").alias("value_sum"))
               .select(ntz_from_instant(F.col("w.start")).alias("window_start"), "event_type", "events", "value_sum"))

    def apply(batch: DataFrame, number: int) -> None:
        one_run(spark, base, source_name(sf_dir))
        write_batch(batch, base, source_name(sf_dir), number)

    progress = run_batches(windows, apply, checkpoint or checkpoint_of(base, sf_dir), "update")
    if late:
        dropped = [(p["id"], p["batchId"], sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])) for p in progress]
        spark.createDataFrame(dropped, "run string, batch long, dropped long").coalesce(1).write.mode("append").parquet(f"{base}/late")
    return totals(written(spark, base, windows.schema), ["window_start", "event_type"])


def late_events(spark: SparkSession, base: str) -> int:
    """How many rows (events, summed per window, type and task beforehand) came too late for their window."""
    if not exists(spark, f"{base}/late"):
        return 0
    return spark.read.parquet(f"{base}/late").groupBy("run", "batch").agg(F.max("dropped").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def longer_windows(days: DataFrame, length: int = 90, step: int | None = None) -> DataFrame:
    """Windows of ``length`` days from daily sums: tumbling (from the epoch on), or starting every ``step`` days.

    The stream's own sliding windows (``velocity_stream(step=...)``) put every
    event into ``length / step`` windows before the first sum; from daily sums
    only a row for each day and type is repeated.
    """
    step = step or length
    day: Column = F.date_diff(F.col("window_start").cast("date"), F.lit(_dt.date(1970, 1, 1)))
    last = F.floor(day / step) * step
    starts = F.sequence(last, last - (length - 1) // step * step, F.lit(-step).cast("long"))
    inside = F.filter(starts, lambda s: s > day - length)
    return (days.select(F.explode(inside).alias("start"), "event_type", "events")
            .groupBy("start", "event_type").agg(F.sum("events").cast("bigint").alias("events"))
            .select(F.date_add(F.lit(_dt.date(1970, 1, 1)), F.col("start").cast("int")).cast("timestamp_ntz").alias("window_start"), "event_type", "events"))


def ingest_stream(spark: SparkSession, landing: str, base: str, now: _dt.datetime, checkpoint: str | None = None,
                  max_files: int | None = None, archive: str | None = None) -> int:
    """Store the items of landing files not yet taken under ``base``; returns how many files these were.

    A file is known by its path and time of change, noted beside the items,
    so calls with other folders, with a new checkpoint, or after a failure
    store every row once.  With ``archive``, files that are done are moved
    there by Spark.  The businesses and reviews are read by
    :mod:`marketlens.sources.landing`.
    """
    stream = (spark.readStream.schema(L.LANDED).option("columnNameOfCorruptRecord", L.CORRUPT))
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    if archive:
        stream = stream.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    taken = []

    def apply(batch: DataFrame, number: int) -> None:
        taken.append(L.take(batch, base, now))

    run_batches(L.with_source(stream.json(landing)), apply, checkpoint or checkpoint_of(base, landing))
    return sum(taken)
