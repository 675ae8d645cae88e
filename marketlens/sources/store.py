"""Stored tables: upsert, append, run bookkeeping, deletes.

Businesses are a bucketed catalog table: an upsert joins the stored side
without moving it, and its result is the table's next version.  Tables that
runs fill are partitioned by run: a delete rewrites the partitions that hold
doomed rows, by dynamic partition overwrite, and leaves the others alone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.scalar import ntz_lit
from marketlens.operators.quality import enforce, review_warnings, split, stars_ok
from marketlens.session import materialize, scratch_path


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


# ---------------------------------------------------------------------------
# S11 / S28 upsert
# ---------------------------------------------------------------------------
def dedupe_latest(incoming: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key: the newest by ``order_col`` (ties: greatest row)."""
    other = [c for c in incoming.columns if c != key]
    g = incoming.groupBy(key).agg(F.max(F.struct(order_col, *[c for c in other if c != order_col])).alias("_r"))     # the row once, not beside its order
    return g.select(key, *[F.col("_r")[c].alias(c) for c in other])


def upsert(existing: DataFrame, incoming: DataFrame, key: str, now: _dt.datetime,
           keep_cols: tuple[str, ...] = ("id", "created_at"), order_col: str = "scraped_at",
           payload_cols: list[str] | None = None) -> DataFrame:
    """``INSERT … ON CONFLICT (key) DO UPDATE`` without a table format.

    * matched: keep the existing ``keep_cols`` (surrogate id, created_at),
      take the incoming payload, ``updated_at = now``;
    * incoming only: new row, ``created_at = updated_at = now``; its id is
      ``xxhash64(key)`` (no sequences on a cluster);
    * existing only: unchanged.  NULL keys never match (UNIQUE admits many
      NULLs) and pass through.

    Plan: the big existing table is only *filtered* by the incoming keys — a
    left-anti join for the untouched rows and a left-semi join for the
    matched ones — so when a batch's keys are small AQE broadcasts them and
    the existing table is never shuffled (a full outer join would shuffle it
    every batch).  Only the matched rows meet the incoming payload.
    """
    return upsert_latest(existing, dedupe_latest(incoming.filter(F.col(key).isNotNull()), key, order_col), key, now, keep_cols, order_col, payload_cols)


def upsert_latest(existing: DataFrame, inc: DataFrame, key: str, now: _dt.datetime,
                  keep_cols: tuple[str, ...] = ("id", "created_at"), order_col: str = "scraped_at",
                  payload_cols: list[str] | None = None) -> DataFrame:
    """:func:`upsert` of incoming rows that are one for each key already; they are read three times, so a caller may store them."""
    payload = payload_cols or [c for c in inc.columns if c not in (key, order_col)]
    keys = inc.select(key)
    untouched = existing.join(keys, key, "left_anti")
    matched = existing.join(keys, key, "left_semi")
    now_lit = ntz_lit(now)
    o = matched.alias("o")
    i = inc.alias("i")
    j = i.join(o, F.col(f"i.{key}") == F.col(f"o.{key}"), "left")
    hit = F.col(f"o.{key}").isNotNull()
    cols = []
    for c in existing.columns:
        if c == key:
            cols.append(F.col(f"i.{key}").alias(key))
        elif c == "id":
            cols.append(F.coalesce(F.col("o.id"), F.xxhash64(F.col(f"i.{key}"))).alias("id"))
        elif c == "created_at":
            cols.append(F.when(hit, F.col("o.created_at")).otherwise(now_lit).alias("created_at"))
        elif c == "updated_at":
            cols.append(now_lit.alias("updated_at"))
        elif c in payload and c not in keep_cols:
            cols.append(F.col(f"i.{c}").alias(c))
        else:
            cols.append(F.col(f"o.{c}").alias(c))
    return untouched.unionByName(j.select(*cols))


# ---------------------------------------------------------------------------
# S11 / S29 the stored side as a bucketed table
# ---------------------------------------------------------------------------
NEXT = "__next"


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store ``df`` as catalog table ``table``, in ``buckets`` of its key, each sorted by it.

    ``buckets`` is the table's parallelism for good: as many as shuffle
    partitions at least (with fewer, Spark moves both sides of a join after
    all), and so many that one is some hundred MB.
    """
    path = scratch_path(df.sparkSession, table)
    spread = df.repartition(buckets, key)          # a file for each bucket, not one for each task and bucket
    spread.write.format("parquet").mode("errorifexists").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def settle(spark: SparkSession, table: str) -> None:
    """Finish a change that stopped between its last two steps."""
    if spark.catalog.tableExists(table + NEXT):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {table}{NEXT}")             # it never came to be: the old version holds
        else:
            spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")


def upsert_bucketed(incoming: DataFrame, table: str, key: str, now: _dt.datetime, buckets: int, order_col: str = "scraped_at") -> DataFrame:
    """:func:`upsert` into a table of :func:`save_bucketed`; returns it as it is now.

    One full outer join on the bucketing key: the stored side is read once
    and not moved, the batch is dealt to its buckets.  The next version is
    written beside the old one and takes its name once its ids are checked,
    so a job that fails before leaves the table as it was.
    """
    spark = incoming.sparkSession
    settle(spark, table)
    save_bucketed(outer_upsert(spark.table(table), incoming, key, now, order_col), table + NEXT, key, buckets)
    out = spark.table(table + NEXT)
    if "id" in out.columns:
        same = out.where(F.col("id").isNotNull()).groupBy("id").agg(F.count_distinct(key).alias("n")).where("n > 1")
        if not same.isEmpty():
            spark.sql(f"DROP TABLE {table}{NEXT}")
            raise ValueError("two keys have the same surrogate id")
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
    return spark.table(table)


def outer_upsert(existing: DataFrame, incoming: DataFrame, key: str, now: _dt.datetime, order_col: str = "scraped_at") -> DataFrame:
    """The rows of :func:`upsert` by one full outer join, for a stored side that lies by its key already."""
    inc = dedupe_latest(incoming.filter(F.col(key).isNotNull()), key, order_col)
    now_lit, o, i = ntz_lit(now), existing.alias("o"), inc.alias("i")
    new, old = F.col(f"i.{key}").isNotNull(), F.col(f"o.{key}").isNotNull()
    cols = []
    for c in existing.columns:
        if c == key:
            value = F.coalesce(F.col(f"o.{key}"), F.col(f"i.{key}"))
        elif c == "id":
            value = F.coalesce(F.col("o.id"), F.when(new, F.xxhash64(F.col(f"i.{key}"))))
        elif c == "created_at":
            value = F.when(new & ~old, now_lit).otherwise(F.col("o.created_at"))
        elif c == "updated_at":
            value = F.when(new, now_lit).otherwise(F.col("o.updated_at"))
        elif c in inc.columns and c != order_col:
            value = F.when(new, F.col(f"i.{c}")).otherwise(F.col(f"o.{c}"))
        else:
            value = F.col(f"o.{c}")
        cols.append(value.alias(c))
    return o.join(i, F.col(f"o.{key}") == F.col(f"i.{key}"), "full_outer").select(*cols)


# ---------------------------------------------------------------------------
# S14 append, S15/S16 runs, S25/S26 deletes
# ---------------------------------------------------------------------------
def append_reviews(batch: DataFrame, path: str, mode: str = "quarantine") -> DataFrame:
    """Validate, then append; returns the accepted rows.

    Rows outside the stars range, or without the business or document they
    must have (where the batch has those columns), are written to
    ``<path>_rejected`` with their reason; in strict mode any such row fails
    the batch.
    """
    ok = {"stars_range": stars_ok(F.col("stars"))}
    ok |= {f"{c}_missing": F.col(c).isNotNull() for c in ("business_id", "review_data") if c in batch.columns}
    every = F.lit(True)
    for rule in ok.values():
        every = every & rule
    if mode == "strict":
        enforce(batch, every, ", ".join(ok), mode)
    good, bad = split(batch, every)
    reason = F.concat_ws(", ", *[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in ok.items()])
    bad.withColumn("reason", reason).write.mode("append").parquet(f"{path}_rejected")
    good.write.mode("append").parquet(path)
    return good


def append_observed(extracted: DataFrame, path: str) -> tuple[DataFrame, dict[str, int], dict[str, tuple | None]]:
    """S14 with S19 in one pass: extracted reviews are stored once, the warnings counted as they go by.

    Accepted and rejected rows are partitions of one write.  Returns the
    accepted rows of the folder, the counts of :func:`dq_report`'s review
    rules over this batch, and for each rule the row with the least id that
    breaks it (id and value; None if none does).
    """
    ok = F.coalesce(stars_ok(F.col("stars")), F.lit(False))
    broken = {"bad_stars": F.col("bad_stars"), "bad_date": F.col("bad_date"), "stars_out_of_range": ~ok}
    samples = [F.min(F.when(c, F.struct("id", F.col("stars").cast("string").alias("value")))).alias(f"sample_{rule}") for rule, c in broken.items()]
    seen = Observation("append-warnings")
    watched = extracted.observe(seen, *[c.alias(rule) for rule, c in review_warnings().items()], *samples)
    watched.withColumn("accepted", ok).write.mode("append").partitionBy("accepted").parquet(path)
    told = seen.get
    counts = {rule: told[rule] for rule in review_warnings()}
    first = {rule: (tuple(told[f"sample_{rule}"]) if told[f"sample_{rule}"] is not None else None) for rule in broken}
    return extracted.sparkSession.read.parquet(path).where(F.col("accepted").cast("string") == "true").drop("accepted"), counts, first


def open_execution(spark: SparkSession, executions: DataFrame, search_query: str | None,
                   now: _dt.datetime) -> DataFrame:
    """Add a 'running' run with the next id (``max(id)+1`` is one aggregate)."""
    nxt = executions.agg(F.coalesce(F.max("id") + 1, F.lit(1)).cast("bigint").alias("id"))
    row = nxt.select(
        "id", ntz_lit(now).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"), F.lit("running").alias("status"),
        F.lit(search_query or "Manual execution").alias("search_query"))
    return executions.select(*row.columns).unionByName(row)


def close_execution(executions: DataFrame, run_id: int, now: _dt.datetime,
                    status: str = "completed") -> DataFrame:
    """Stamp status/completed_at of one run (projection, no join)."""
    hit = F.col("id") == F.lit(run_id)
    return executions.select(
        *[F.when(hit, ntz_lit(now)).otherwise(F.col(c)).alias(c) if c == "completed_at"
          else F.when(hit, F.lit(status)).otherwise(F.col(c)).alias(c) if c == "status"
          else F.col(c) for c in executions.columns])


def cascade_delete(executions: DataFrame, businesses: DataFrame, reviews: DataFrame,
                   doomed_runs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """ON DELETE CASCADE run → businesses → reviews as chained anti-joins."""
    runs = doomed_runs.select(F.col("id").alias("execution_id"))
    e2 = executions.join(runs.withColumnRenamed("execution_id", "id"), "id", "left_anti")
    doomed_b = businesses.join(runs, "execution_id", "left_semi").select(F.col("id").alias("business_id"))
    b2 = businesses.join(doomed_b.withColumnRenamed("business_id", "id"), "id", "left_anti")
    r2 = reviews.join(doomed_b, "business_id", "left_anti")
    return e2, b2, r2


def delete_by_query(reviews: DataFrame, businesses: DataFrame, executions: DataFrame,
                    search_query: str) -> DataFrame:
    """DELETE reviews WHERE business_id IN (businesses of runs with a query)."""
    runs = executions.filter(F.col("search_query") == search_query).select(F.col("id").alias("execution_id"))
    ids = businesses.join(runs, "execution_id", "left_semi").select(F.col("id").alias("business_id"))
    return reviews.join(ids, "business_id", "left_anti")


# ---------------------------------------------------------------------------
# S25 / S26 on stored tables
# ---------------------------------------------------------------------------
RUN = "execution_id"


def save_by_run(df: DataFrame, path: str) -> None:
    """Store rows in a partition for each run; a busy run's rows stay in as many files as tasks wrote them."""
    df.write.mode("errorifexists").partitionBy(RUN).parquet(path)


def stored_by_run(spark: SparkSession, path: str, of: DataFrame) -> DataFrame:
    """The rows of such a table, ``of`` being the rows it was first made of (for its columns' types)."""
    kinds = of.schema
    if not exists(spark, path):
        return of.where(F.lit(False))
    return spark.read.schema(kinds).parquet(path).select(*of.columns)


def delete_rows(table: DataFrame, path: str, doomed: DataFrame, key: str) -> list[int | None]:
    """Delete the rows of ``table`` (stored by run under ``path``) whose ``key`` is in ``doomed`` (columns of run and key); returns the runs rewritten.

    Only partitions of runs that ``doomed`` names are read and written.
    What stays of them is written elsewhere first, then overwrites them;
    partitions of which nothing stays go.
    """
    spark = table.sparkSession
    runs = [r[0] for r in doomed.select(RUN).distinct().collect()]            # as many as runs
    if not runs:
        return []
    of_runs = F.col(RUN).isin([r for r in runs if r is not None])
    touched = table.where(of_runs | F.col(RUN).isNull() if None in runs else of_runs)
    left = materialize(touched.join(doomed.select(key).distinct(), key, "left_anti").select(*table.columns), "rows-left")
    stay = {r[0] for r in left.select(RUN).distinct().collect()}
    left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)
    for run in runs:
        if run not in stay:
            fs, p = _fs(spark, f"{path}/{RUN}={'__HIVE_DEFAULT_PARTITION__' if run is None else run}")
            fs.delete(p, True)
    return runs


def delete_runs(spark: SparkSession, paths: list[str], runs: list[int]) -> None:
    """S25 on stored tables: whole partitions of the runs go, from every table that has them; no row is read."""
    for path in paths:
        for run in runs:
            fs, p = _fs(spark, f"{path}/{RUN}={run}")
            fs.delete(p, True)
