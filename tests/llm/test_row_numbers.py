"""Results must not change when the scans of one run cut their input differently, as they do when executors come or go."""

import random

import pytest

import corpus_pipeline
from marketlens.llm import decontaminate, line_dedup

SPLITS = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def later_splits(spark):
    """Cuts files into small splits from the moment it is called."""
    yield lambda: spark.conf.set(SPLITS, "4096")
    spark.conf.unset(SPLITS)


def texts(n):
    rng = random.Random(7)
    own = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    return [(k, " ".join(own() for _ in range(20)) + f"\n{'The same line stands here.' if k % 3 == 0 else own() * 3}") for k in range(n)]


def test_lines(stored_docs, later_splits):
    rows = texts(300)
    found = line_dedup.dedup_lines(stored_docs(rows))
    later_splits()
    got = {r.doc_id: r for r in found.collect()}
    assert got[0].removed == []
    assert all(got[i].removed == ([1] if i and i % 3 == 0 else []) for i, _ in rows)


def test_benchmark(spark, stored_docs, later_splits):
    rows = texts(300)
    items = spark.createDataFrame([(1, rows[17][1].split("\n")[0]), (2, rows[230][1].split("\n")[0])], "item_id long, text string")
    found = decontaminate.decontaminate(stored_docs(rows), items)
    later_splits()
    assert {r.doc_id: list(r.item_ids) for r in found.where("contaminated").collect()} == {17: [1], 230: [2]}


def test_pipeline_near_duplicates(spark, stored_docs, later_splits):
    rows = texts(300)
    copies = [(1000 + i, t) for i, t in rows[:40]]
    left = corpus_pipeline.simhash_near_dedup(spark, stored_docs(rows + copies), "")
    later_splits()
    assert sorted(r.doc_id for r in left.collect()) == [i for i, _ in rows]
