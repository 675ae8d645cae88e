"""SparkSession construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets.  AQE re-plans joins from measured shuffle
# sizes (size-checked broadcast with a sort-merge fallback), coalesces small
# shuffle partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "marketlens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine's defaults.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]``.  Shuffle partitions default to AQE's coalescing from a
    generous initial number, so the same code holds at 100 TB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001  (Spark Connect)
        pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    The cluster names it in ``spark.checkpoint.dir``; only a ``local`` master
    (tests) may leave it unset and gets a folder under the system temp dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:                                   # classic session; Spark Connect has no SparkContext
        sc = spark.sparkContext
        d = d or sc.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001
        sc = None
    if not d:
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="marketlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of recomputing
    the upstream scan) and lets several consumers share one computation
    without caching on executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
