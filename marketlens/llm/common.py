"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space and \x09-\x0D (what ``bytes.split()`` splits on).
SPACES = b" \t\n\x0b\x0c\r"
#: A-Z to a-z on bytes, everything else unchanged.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: Bytes that a batch between Spark and Python may hold; texts are long, so 10,000 rows would be many more.
BATCH_BYTES = "4m"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python workers by their size, for as long as the session lasts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def release() -> None:
    """Hand freed memory back to the system: Python workers serve many tasks, of other stages too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not glibc
        pass


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with batches of bounded size and workers that keep nothing from a task."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        release()

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Only a local master may go without it (tests); a cluster must name one.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, computes once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The column that :func:`numbered` adds.
ROW = "row number"


def numbered(docs: DataFrame, columns: list[str], name: str, codec: str = "snappy") -> DataFrame:
    """Some columns, and a number of each row that is written once, so that every pass reads the same one.

    (Numbers made by a scan follow its file splits, and those follow the
    cores at hand.)  A table that has the numbers is returned as it is.
    """
    if ROW in docs.columns:
        return docs
    return stored(docs.select(*columns, F.monotonically_increasing_id().alias(ROW)), f"{name}-rows", codec)


def id_crc32(doc_id: Column) -> Column:
    """crc32 of the id as text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
