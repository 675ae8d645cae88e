"""Decisions of the scale guards: size-checked broadcast, scans as Spark plans them."""

from pyspark.sql import functions as F

from marketlens.operators.broadcast import bounded_broadcast
from marketlens.sources import tables


def _has_broadcast_hint(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_broadcast_only_under_the_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert _has_broadcast_hint(bounded_broadcast(small, 100))
    assert not _has_broadcast_hint(bounded_broadcast(big, 100))     # falls back to a plain (shuffle) join side


def test_broadcast_join_plan_uses_hint_only_when_small(spark):
    fact = spark.range(5000).withColumn("k", F.col("id") % 7)
    dim = spark.range(7).withColumnRenamed("id", "k")
    plan = fact.join(bounded_broadcast(dim, 100), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_tables_are_read_as_planned(spark, sf_dir):
    assert "RoundRobinPartitioning" not in tables.read_table(spark, sf_dir, "orders")._jdf.queryExecution().executedPlan().toString()
