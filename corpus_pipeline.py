"""The corpus pipeline: five stages over ``documents``, each one of the operators of ``marketlens.llm``.

Every stage reads a stored table (the one before it was written as Parquet),
judges all of its rows, and all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import bpe, classifier, line_dedup, simhash
from marketlens.llm.common import ROW, numbered, stored, table
from marketlens.llm.decontaminate import decontaminate as find_benchmark
from marketlens.operators.broadcast import bounded_broadcast

#: Copies of whole texts stay on the disk until the last stage, so they are packed closer than by default.
CODEC = "zstd"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Row numbers of documents to drop are broadcast up to so many, counted first; beyond, rows are shuffled.
BROADCAST_ROWS = 1_000_000


def without(docs: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """The rows of a numbered table whose number is not in ``dropped`` (column row)."""
    numbers = bounded_broadcast(stored(dropped.select("row"), f"pipeline-{name}-dropped"), BROADCAST_ROWS)
    return docs.select(*COLUMNS, docs[ROW].alias("row")).join(numbers, "row", "left_anti").select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranker accepts, learned from the marked ones."""
    docs = docs.select(*COLUMNS)
    ranker = classifier.train(docs, table(spark, sf_dir, "labels"))
    return classifier.score(docs, ranker, keep=COLUMNS).where("predicted = 1").select(*COLUMNS)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document, or an earlier line, has; documents of nothing else go."""
    docs = numbered(docs, ["doc_id", "text", "lang", "source"], "pipeline-lines", CODEC)
    cleaned = line_dedup.dedup_lines(docs, keep=("doc_id", "lang", "source"), name="pipeline-lines")
    emptied = (F.size("removed") > 0) & ~F.col("text").rlike(r"\S")
    return cleaned.where(~emptied).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    docs = numbered(docs, COLUMNS, "pipeline-simhash", CODEC)
    found = simhash.near_duplicates(docs, name="pipeline-simhash")
    return without(docs, found.where(~F.col("stays")), "simhash")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    docs = numbered(docs, COLUMNS, "pipeline-benchmark", CODEC)
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"), name="pipeline-benchmark")
    return without(docs, found.where("contaminated"), "benchmark")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of what they decode to."""
    vocabulary = bpe.default_vocabulary(spark)
    # Stored in between, so that no task has the workers of both at once.
    decoded = bpe.decode(stored(bpe.encode(docs, vocabulary), "pipeline-ids", CODEC), vocabulary)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: No SQL expresses the learned ranker or the encoder; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what the one before it kept; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
