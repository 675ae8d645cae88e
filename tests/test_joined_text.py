"""Joined texts in pieces: exact to the letter, bounded, a large group spread over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from marketlens.operators import joined_text as J

SCHEMA = "category string, city string, id long, txt string, part long"


@pytest.fixture
def many_partitions(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def made(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        category, city = ("hot", "hot") if i % 3 == 0 else (rng.choice(["a", None, ""]), rng.choice(["p", None]))
        rows.append((category, city, i, rng.choice([None, "", "x", "word " * rng.randint(1, 8), "é 字 | y", "z" * 300]), 7))
    return rows


def plain(rows, sep, by_text):
    groups = {}
    for category, city, i, txt, _ in rows:
        if txt is not None:
            groups.setdefault((category, city), []).append((txt if by_text else "", i, txt))
    return {k: sep.join(t for _, _, t in sorted(v)) for k, v in groups.items()}


@pytest.mark.parametrize("order", [["id"], ["txt", "id"]])
@pytest.mark.parametrize(("sep", "piece"), [(" | ", 50), ("", 7), (", ", 1 << 20)])
def test_pieces_put_together_are_the_joined_text(spark, many_partitions, order, sep, piece):
    rows = made(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    pieces = J.joined_pieces(df, ["category", "city"], "txt", order, sep, piece)
    got = {}
    for r in sorted(pieces.collect(), key=lambda r: r.part):
        assert len(r.text) <= piece + 300 + len(sep)
        got[r.category, r.city] = got.get((r.category, r.city), "") + r.text
    want = plain(rows, sep, order[0] == "txt")
    assert got == want
    assert {(r.category, r.city): r.joined for r in J.joined_texts(pieces, ["category", "city"], "joined").collect()} == want


def test_a_large_group_is_spread_over_tasks(spark, many_partitions):
    """Of one group with nine tenths of all rows no task of any shuffle gets more than a fifth."""
    df = spark.range(20000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 50).otherwise(-1).alias("k"), "id", F.lit("same text").alias("txt"))
    pieces = J.joined_pieces(df, ["k"], "txt", ["id"], " | ", 2000)
    assert pieces.where("k = -1").select(F.spark_partition_id().alias("p"), F.length("text").alias("n")).groupBy("p").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] < 18000 * 12 / 5
    stored = [n for n in pieces._jdf.queryExecution().analyzed().toString().split("\n") if "Relation" in n]
    assert stored                                       # the sorted rows were stored, not sorted again
    assert sum(len(r.text) for r in pieces.where("k = -1").collect()) == 18000 * 9 + 17999 * 3


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert J.joined_pieces(df, ["category"], "txt", ["id"], ",").collect() == []
    only_null = spark.createDataFrame([("a", "b", 1, None, 1)], SCHEMA)
    assert J.joined_pieces(only_null, ["category"], "txt", ["id"], ",").collect() == []
