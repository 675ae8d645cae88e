"""What stored and moved data must not do as tables grow."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlens.operators import search as S
from marketlens.plans import registry as R
from marketlens.sources import landing as L
from marketlens.sources import places as P
from marketlens.streaming import jobs as SJ


@pytest.fixture(scope="module")
def market_dir(spark, tmp_path_factory):
    """Places whose reviews lie on many pages, one without reviews, one that comes twice, and reviews of no place."""
    d = str(tmp_path_factory.mktemp("market"))
    spark.createDataFrame([(0, "AFRICA"), (1, "ASIA")], "r_regionkey long, r_name string").write.parquet(f"{d}/region.parquet")
    spark.createDataFrame([(k, f"N{k}", k % 2) for k in range(5)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{d}/nation.parquet")
    places = [(k, f"Customer {k}", k % 5, "BUILDING") for k in [*range(1, 41), 7]]
    spark.createDataFrame(places, "c_custkey long, c_name string, c_nationkey long, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    orders = [(17 * k, 1 + k % 39) for k in range(1, 2000)] + [(40_001, 999), (40_002, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{d}/orders.parquet")
    return d


def _files(path, end):
    return [os.path.join(path, f) for f in os.listdir(path) if f.endswith(end)]


def test_items_are_whole_and_reviews_move_once(spark, market_dir):
    items = P.place_items(spark, market_dir)
    rows = items.select("cid", "scrapedAt", F.size("reviews").alias("n")).collect()
    orders = [(17 * k, 1 + k % 39) for k in range(1, 2000)]
    want = {}
    for order, place in orders:
        want[place, order // 1000] = want.get((place, order // 1000), 0) + 1
    assert sum(r.n for r in rows) == len(orders) + sum(n for (place, _), n in want.items() if place == 7)
    assert len(rows) == len(want) + sum(place == 7 for place, _ in want) + 1 and [r.n for r in rows if r.cid == "40"] == [0]
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("market-business_reviews") <= 1 and plan.count("collect_list") == 1 and plan.count("Join") == 1


def test_landed_lines_are_compressed(spark, market_dir, tmp_path):
    path = P.land_places(P.place_items(spark, market_dir), str(tmp_path / "landed"))
    plain = sum(len(x.value) for x in spark.read.text(path).collect())
    assert sum(map(os.path.getsize, _files(path, ".json.gz"))) * 4 < plain
    assert P.read_places(spark, path).count() == P.place_items(spark, market_dir).count()


def test_rejected_lines_store_no_accepted_item(spark, market_dir, monkeypatch):
    from marketlens import session
    kept = []
    monkeypatch.setattr(session, "materialize", lambda df, name, was=session.materialize: kept.append(was(df, name)) or kept[-1])
    lines = [r.line for r in R.INGEST_QUERIES["ingest_rejected_lines"](spark, market_dir).collect()]
    assert lines and kept[0].count() == len(lines)


def test_arrays_are_as_many_as_their_items_need(spark, market_dir, tmp_path):
    items = P.place_items(spark, market_dir)
    path = str(tmp_path / "pretty")
    R._land_arrays(items, items.count(), path)
    assert len(_files(path, ".txt")) == 1
    got = {(r.cid, r.title, r.reviewsCount) for r in R.INGEST_QUERIES["ingest_accepted_places"](spark, market_dir).where("read_as = 'arrays'").collect()}
    assert got == {(r.cid, r.title, r.reviewsCount) for r in items.select("cid", "title", "reviewsCount").collect()}


def _held(v):
    """A value as its JSON text says it: fields that are NULL left out, reviews in the order of their ids."""
    if isinstance(v, list):
        return sorted(map(_held, v), key=lambda x: x["reviewId"]) if v and "reviewId" in v[0] else [_held(x) for x in v]
    return {k: _held(x) for k, x in v.items() if x is not None} if isinstance(v, dict) else v


def _items(rows):
    return sorted((_held(r) for r in rows), key=lambda x: (x["cid"], x["scrapedAt"]))


def test_accepted_places_are_whole_items_from_lines_and_arrays(spark, market_dir):
    """A place that comes twice is told once; each of its pages is an item of its own, with its reviews."""
    items = P.place_items(spark, market_dir)
    once = {json.dumps(x, sort_keys=True): x for x in _items(r.asDict(recursive=True) for r in items.collect())}
    want = _items(once.values())
    got = R.INGEST_QUERIES["ingest_accepted_places"](spark, market_dir).collect()
    assert _items(json.loads(r.item) for r in got if r.read_as == "arrays") == want
    assert _items(json.loads(r.item) for r in got if r.read_as == "lines") == [x for x in want if int(x["cid"]) not in (25, 40)]
    assert sum(len(x["reviews"]) for x in want) == 1999 and all((r.cid, r.title, r.reviewsCount) == tuple(json.loads(r.item)[k] for k in ("cid", "title", "reviewsCount")) for r in got)


def test_arrays_hold_all_fields_and_reviews_of_their_items(spark, market_dir, tmp_path):
    items = P.place_items(spark, market_dir)
    path = str(tmp_path / "pretty")
    R._land_arrays(items, items.count(), path, **P.LANDED_FILES)
    assert len(_files(path, ".txt.gz")) == 1
    read = L.accepted_items(L.read_landed(spark, path, multi_line=True)).select(*P.PLACE.names)
    assert _items(r.asDict(recursive=True) for r in read.collect()) == _items(r.asDict(recursive=True) for r in items.collect())


def test_arrays_are_bounded_by_their_signs(monkeypatch):
    monkeypatch.setattr(R, "ARRAY_SIZE", 100)
    items = [json.dumps({"cid": str(k), "title": "é" * (k % 60)}, ensure_ascii=False) for k in range(200)] + [json.dumps({"cid": "long", "title": "x" * 500})]
    batches = pa.table({"item": items}).to_batches(7)
    texts = [b.column(0)[0].as_py() for b in R._arrays(iter(batches))]
    assert [x for t in texts for x in json.loads(t)] == [json.loads(x) for x in items]
    assert all(len(json.loads(t)) == 1 or sum(len(json.dumps(x, ensure_ascii=False)) for x in json.loads(t)) <= 100 for t in texts) and len(texts) < len(items)
    assert not list(R._arrays(iter([])))


def test_an_item_one_of_whose_fields_cannot_be_read_is_not_accepted(spark, market_dir, monkeypatch, tmp_path):
    """A field of the item's review counts as any other."""
    lines = ['{"cid": "1", "title": "a", "reviewsCount": 1, "scrapedAt": "x", "reviews": [{"reviewId": "r1", "stars": 4}]}',
             '{"cid": "2", "title": "b", "reviewsCount": 1, "scrapedAt": "x", "reviews": [{"reviewId": "r2", "stars": "many"}]}',
             '{"cid": "3", "title": "c", "reviewsCount": 1, "scrapedAt": "x", "rank": {}}']
    path = str(tmp_path / "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    monkeypatch.setattr(R, "_landing_with_errors", lambda s, d: path)
    got = R.INGEST_QUERIES["ingest_accepted_places"](spark, market_dir).where("read_as = 'lines'").collect()
    assert [r.cid for r in got] == ["1"] and json.loads(got[0].item)["reviews"] == [{"reviewId": "r1", "stars": 4}]
    assert [r.line for r in R.INGEST_QUERIES["ingest_rejected_lines"](spark, market_dir).orderBy("line").collect()] == lines[1:]


def test_runs_of_postings_are_bounded_and_sorted(monkeypatch):
    monkeypatch.setattr(S, "RUN_TOKENS", 50)
    monkeypatch.setattr(S, "KNOWN_WORDS", 3)
    texts = {k: [f"word{(k * j) % 13}" for j in range(k % 40)] + ["the"] * (k % 3) for k in range(120)} | {200: ["cats"] * 300, 201: None}
    batches = pa.table({"id": list(texts), "tokens": pa.array(list(texts.values()), pa.list_(pa.string()))}).to_batches(50)
    out = list(S._runs(iter(batches)))
    got = sorted(r for b in out for r in zip(b.column(1).to_pylist(), b.column(0).to_pylist(), b.column(2).to_pylist()))
    want = {}
    for k, words in texts.items():
        for at, w in enumerate(words or [], 1):
            if w != "the":
                want.setdefault((k, S.lexeme(w)), []).append(at)
    assert got == sorted((*k, at) for k, at in want.items())
    assert len(out) > 20 and all(b.column(0).to_pylist() == sorted(b.column(0).to_pylist()) for b in out)


def test_postings_are_not_moved_and_equal_grouped_tokens(spark):
    """Stop words only, no words, NULL texts and ids; then ids that come twice."""
    once = [(k, " ".join(f"Parking w{(k * j) % 13} the É{j % 5}-lists" for j in range(k % 40))) for k in range(120)] + [(500, "the of and"), (501, ""), (502, None), (None, "parking")]
    for rows in (once, once + [(3, "parking, parked and parks"), (4, None), (500, "Lists")]):
        df = spark.createDataFrame(rows, "id long, t string").repartition(3)
        table = S.postings(df, "id", "t")
        got = sorted((r.id, r.stem, r.positions) for r in table.collect())
        want = {}
        for r in S.token_table(df.where("id IS NOT NULL"), "id", "t").collect():
            want.setdefault((r.id, r.stem), []).append(r.pos)
        assert got == sorted((i, s, sorted(at)) for (i, s), at in want.items())
        assert rows is not once or "hashpartitioning" not in table._jdf.queryExecution().executedPlan().toString()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_chain_reads_its_items_for_what_it_stores_only(spark, market_dir):
    """Of reviews delivered twice one stays; stars out of range, and places nobody knows, are told once."""
    found = R._chain(spark, market_dir)
    assert "] json" not in _plan(found.rejects) and "] json" not in _plan(found.reviews)
    orders = {17 * k for k in range(1, 2000)}
    assert sorted((r.review_id, r.reason) for r in found.rejects.collect()) == sorted((f"r{o}", "stars_range") for o in orders if o % 41 == 0)
    assert sorted(r.review_id for r in found.reviews.select("review_id").collect()) == sorted(f"r{o}" for o in orders if o % 41)


def test_rejects_of_unknown_places_and_bad_stars_are_told_in_one_pass(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("b", 1, None), ("c", 1, 99), ("d", None, 4), ("e", None, 99)], "review_id string, business_id long, stars int")
    good, bad = L.accepted_and_rejected(rows)
    assert [r.review_id for r in good.collect()] == ["a", "b"]
    assert sorted(map(tuple, bad.collect())) == [("c", "stars_range"), ("d", "no_business"), ("e", "no_business")]
    assert "Union" not in _plan(bad)


def test_items_are_dealt_by_place_before_they_are_sorted_and_reviews_resolved_without_documents(spark, market_dir, tmp_path):
    landing, base = P.land_places(P.place_items(spark, market_dir), str(tmp_path / "landing")), str(tmp_path / "stored")
    SJ.ingest_stream(spark, landing, base, R.NOW)
    empty = spark.createDataFrame([], "id long, apify_place_id string, business_name string, review_count int, business_data string, created_at timestamp_ntz, updated_at timestamp_ntz")
    stored = L.stored_businesses(spark, base, empty)
    sides = stored._jdf.queryExecution().executedPlan().toString()
    assert sides.count("SortAggregate") and all("Exchange" in x for x in sides.split("partial_max(struct(")[1:])
    assert {r.apify_place_id for r in stored.collect()} == {f"https://maps.example.com/?cid={k}" for k in range(1, 41)}
    good, bad = L.stored_reviews(spark, base, stored)
    assert "review_data" not in _plan(good) and good.count() == 1999 and bad.count() == 0
