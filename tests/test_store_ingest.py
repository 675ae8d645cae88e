import datetime as dt
import decimal
import json
import os

import pytest
from pyspark.sql import functions as F

from marketlens.operators.session_memory import session_memory
from marketlens.plans import queries as Qy
from marketlens.plans import registry as R
from marketlens.session import materialize
from marketlens.sources import fixture as fx
from marketlens.sources import landing as L
from marketlens.sources import places as P
from marketlens.sources import store as S
from marketlens.streaming import jobs as SJ

NOW = dt.datetime(2025, 10, 1, 6)


def test_upsert_keeps_identity_and_takes_latest(spark):
    old = spark.createDataFrame([(1, "k1", 10, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1)),
                                 (2, "k2", 20, dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 2)),
                                 (3, None, 30, dt.datetime(2025, 1, 3), dt.datetime(2025, 1, 3))],
                                "id long, key string, n int, created_at timestamp_ntz, updated_at timestamp_ntz")
    inc = spark.createDataFrame([("k1", 11, dt.datetime(2025, 9, 1)), ("k1", 12, dt.datetime(2025, 9, 2)),
                                 ("k9", 90, dt.datetime(2025, 9, 1))],
                                "key string, n int, scraped_at timestamp_ntz")
    out = {r["key"]: r for r in S.upsert(old, inc, "key", NOW).collect()}
    assert out["k1"]["id"] == 1 and out["k1"]["n"] == 12 and out["k1"]["updated_at"] == NOW
    assert out["k1"]["created_at"] == dt.datetime(2025, 1, 1)
    assert out["k2"]["n"] == 20 and out["k2"]["updated_at"] == dt.datetime(2025, 1, 2)
    assert out["k9"]["created_at"] == NOW and out["k9"]["id"] is not None
    assert out[None]["n"] == 30      # NULL keys never match and pass through


OLD = "id long, key string, n int, created_at timestamp_ntz, updated_at timestamp_ntz"


def test_upsert_into_a_bucketed_table(spark, sf_dir):
    """The same rows as the plain upsert, round after round; the stored side is neither shuffled nor sorted."""
    t0 = dt.datetime(2025, 1, 1)
    plain = spark.createDataFrame([(k, f"k{k}", k, t0, t0) for k in range(50)] + [(90, None, 1, t0, t0), (91, None, 2, t0, t0)], OLD)
    S.save_bucketed(plain, "upsert_test", "key", 4)
    for step in range(3):
        inc = spark.createDataFrame([(f"k{k}", 100 * step + k, dt.datetime(2025, 9, 1 + step)) for k in range(40 + step, 60 + step)] + [(None, 5, t0)], "key string, n int, scraped_at timestamp_ntz")
        now = dt.datetime(2025, 10, 1 + step)
        plan = S.outer_upsert(spark.table("upsert_test"), inc, "key", now)._jdf.queryExecution().executedPlan().toString()
        stored_side = plan[:plan.index("Scan parquet")].rsplit("Join", 1)[1]
        assert "Bucketed: true" in plan and "Exchange" not in stored_side
        plain = S.upsert(plain, inc, "key", now).select(*plain.columns)
        got = S.upsert_bucketed(inc, "upsert_test", "key", now, 4)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    # A failure between the last two steps is finished by the next call.
    spark.sql("ALTER TABLE upsert_test RENAME TO upsert_test__next")
    S.settle(spark, "upsert_test")
    assert spark.table("upsert_test").count() == plain.count()
    spark.sql("DROP TABLE upsert_test")


def test_two_keys_of_one_id_are_refused_and_the_table_stays(spark):
    t0 = dt.datetime(2025, 1, 1)
    clash = spark.sql("SELECT xxhash64('new') AS h").first().h
    S.save_bucketed(spark.createDataFrame([(clash, "old", 1, t0, t0)], OLD), "clash_test", "key", 4)
    with pytest.raises(ValueError):
        S.upsert_bucketed(spark.createDataFrame([("new", 2, t0)], "key string, n int, scraped_at timestamp_ntz"), "clash_test", "key", NOW, 4)
    assert [r["key"] for r in spark.table("clash_test").collect()] == ["old"]
    spark.sql("DROP TABLE clash_test")


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_deletes_rewrite_only_partitions_with_doomed_rows(spark, tmp_path):
    path = str(tmp_path / "by_run")
    rows = spark.range(100).select("id", (F.col("id") % 20).alias("business_id"), F.when(F.col("id") % 10 < 9, F.col("id") % 5).alias("execution_id"))
    S.save_by_run(rows, path)
    before = _files(path)
    doomed = spark.createDataFrame([(1, 1), (1, 6), (2, 2), (2, 7), (2, 12), (2, 17), (None, 19)], "execution_id long, business_id long")
    assert sorted(S.delete_rows(S.stored_by_run(spark, path, rows), path, doomed, "business_id"), key=str) == [1, 2, None]
    keep = rows.where("NOT coalesce((execution_id = 1 AND business_id IN (1, 6)) OR execution_id = 2, false) AND NOT (execution_id IS NULL AND business_id = 19)")
    assert sorted(r.id for r in S.stored_by_run(spark, path, rows).collect()) == sorted(r.id for r in keep.collect())
    after = _files(path)
    for run in (0, 3, 4):
        same = {f: t for f, t in before.items() if f"execution_id={run}/" in f}
        assert same and all(after.get(f) == t for f, t in same.items())
    assert not any("execution_id=2/" in f for f in after)
    S.delete_runs(spark, [path], [0, 4, 99])
    assert S.stored_by_run(spark, path, rows).where("execution_id IN (0, 2, 4)").count() == 0


def test_append_reviews_keeps_rejected_rows(spark, tmp_path):
    path = str(tmp_path / "reviews")
    batch = spark.createDataFrame([(1, 5, 7), (2, 99, 7), (3, 4, None)], "id long, stars int, business_id long")
    with pytest.raises(ValueError):
        S.append_reviews(batch, path, mode="strict")
    assert [r["id"] for r in S.append_reviews(batch, path).collect()] == [1]
    assert spark.read.parquet(path).count() == 1
    assert {(r["id"], r["reason"]) for r in spark.read.parquet(f"{path}_rejected").collect()} == {(2, "stars_range"), (3, "business_id_missing")}


def test_open_close_execution(spark, sf_dir):
    e = S.open_execution(spark, fx.executions(spark, sf_dir), None, NOW)
    last = e.orderBy(F.desc("id")).first()
    assert last["status"] == "running" and last["search_query"] == "Manual execution"
    closed = S.close_execution(e, last["id"], NOW)
    assert closed.filter(F.col("id") == last["id"]).first()["status"] == "completed"


def test_resolve_business_name_fallback_only_when_unique(spark):
    b = spark.createDataFrame([(1, "pa", "Solo", "{}"), (2, "pb", "Twin", "{}"), (3, "pc", "Twin", "{}")],
                              "id long, apify_place_id string, business_name string, business_data string")
    fr = spark.createDataFrame([("zz", "Solo", None, "r1", "{}"), ("zz", "Twin", None, "r2", "{}"),
                                ("pb", "Other", None, "r3", "{}")],
                               "apify_place_id string, place_name string, place_url string, review_id string, "
                               "review_data string")
    ok, bad = P.resolve_business(fr, b)
    assert {(r["review_id"], r["business_id"]) for r in ok.collect()} == {("r1", 1), ("r3", 2)}
    assert [r["review_id"] for r in bad.collect()] == ["r2"]


def test_scalar_subquery_rejects_ambiguous_name(spark, sf_dir):
    b, r = fx.businesses(spark, sf_dir), fx.reviews(spark, sf_dir)
    with pytest.raises(Exception):
        Qy.reviews_of_business(b, r, name_like="Customer#00000001").collect()


def test_session_memory_keeps_last_turns(spark):
    df = spark.createDataFrame([(1, t, "user", "x") for t in range(15)] + [(2, 0, "user", "y")],
                               "conv_id long, turn long, role string, text string")
    out = session_memory(df, n=10)
    assert out.filter("conv_id = 1").agg(F.min("turn")).first()[0] == 5
    assert out.count() == 11


def _four_files(spark, sf_dir, name, tmp_path):
    spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(4, F.rand(7)).write.parquet(f"{tmp_path}/four/{name}.parquet")
    for other in ("customer", "nation", "region", "orders"):
        if other != name:
            os.symlink(f"{sf_dir}/{other}.parquet", f"{tmp_path}/four/{other}.parquet")
    return f"{tmp_path}/four"


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_streams_do_not_depend_on_batches(spark, sf_dir, tmp_path, scheme):
    four = scheme + _four_files(spark, sf_dir, "orders", tmp_path)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    once = SJ.review_stream(spark, sf_dir)
    parts = SJ.review_stream(spark, four, max_files=1)
    assert once.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert key(parts) == key(once)
    assert key(SJ.run_counter_stream(spark, four, max_files=1)) == key(SJ.run_counter_stream(spark, sf_dir))


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_windows_do_not_depend_on_batches(spark, sf_dir, tmp_path, scheme):
    four = scheme + _four_files(spark, sf_dir, "events", tmp_path)
    key = lambda df: sorted(map(tuple, df.select("window_start", "event_type", "events").collect()), key=repr)
    days = SJ.velocity_stream(spark, four, max_files=1)
    assert key(days) == key(SJ.velocity_stream(spark, sf_dir))
    assert days.agg(F.sum("events")).first()[0] == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("t", F.col("ts").cast("timestamp"))
    for step in (90, 1):
        direct = ev.groupBy(F.window("t", "90 days", f"{step} days").alias("w"), "event_type").agg(F.count("*").alias("events"))
        assert key(SJ.longer_windows(days, step=step)) == key(direct.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "events"))


def _key(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _landed(spark, sf_dir, path, places, parts=3):
    items = P.place_items(spark, sf_dir).filter(F.col("placeId").isin(*[f"place_{k}" for k in places]))
    return P.land_places(items.repartition(parts), path), items


EMPTY = "id long, apify_place_id string, business_name string, review_count int, business_data string, created_at timestamp_ntz, updated_at timestamp_ntz"


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_ingest_stores_every_row_once_whatever_the_calls(spark, sf_dir, tmp_path, scheme):
    base, empty = f"{scheme}{tmp_path}/stored", spark.createDataFrame([], EMPTY)
    one, items = _landed(spark, sf_dir, f"{scheme}{tmp_path}/one", range(1, 5))
    two, more = _landed(spark, sf_dir, f"{scheme}{tmp_path}/two", range(5, 9))
    later = dt.datetime(2025, 10, 8, 6)
    assert SJ.ingest_stream(spark, one, base, NOW, max_files=1) > 0
    assert SJ.ingest_stream(spark, one, base, NOW, max_files=1) == 0                                           # nothing new
    assert SJ.ingest_stream(spark, two, base, later, max_files=2) > 0                                          # another folder
    for lost in ("a", "b"):
        assert SJ.ingest_stream(spark, one, base, later, checkpoint=f"{scheme}{tmp_path}/{lost}-one") == 0    # a lost checkpoint
        assert SJ.ingest_stream(spark, two, base, later, checkpoint=f"{scheme}{tmp_path}/{lost}-two") == 0
    every = items.unionByName(more)
    n_reviews = every.select(F.explode("reviews")).count()
    assert L.stored_items(spark, base).count() == every.count()
    stored = L.stored_businesses(spark, base, empty)
    assert {r.business_name: (r.created_at, r.updated_at) for r in stored.collect()} == \
        {r.title: (NOW, NOW) for r in items.collect()} | {r.title: (later, later) for r in more.collect()}
    good, bad = L.stored_reviews(spark, base, stored)
    assert n_reviews > 0 and good.count() == n_reviews and bad.count() == 0
    # The same places delivered again in new files: the rows are stored, businesses and reviews stay one each.
    again, _ = _landed(spark, sf_dir, f"{scheme}{tmp_path}/again", range(1, 3), parts=2)
    assert SJ.ingest_stream(spark, again, base, later) > 0
    stored = L.stored_businesses(spark, base, empty)
    assert stored.count() == 8 and stored.where(F.col("created_at") < F.col("updated_at")).count() == 2
    assert L.stored_reviews(spark, base, stored)[0].count() == n_reviews


def test_a_load_whose_files_were_not_noted_is_never_read_and_taken_again(spark, sf_dir, tmp_path):
    landing, items = _landed(spark, sf_dir, f"{tmp_path}/landing", range(1, 4))
    base = f"{tmp_path}/stored"
    L.read_landed(spark, landing).withColumn("load", F.lit("failed")).write.partitionBy("load").parquet(f"{base}/items")
    assert L.stored_items(spark, base).count() == 0
    SJ.ingest_stream(spark, landing, base, NOW)
    assert L.stored_items(spark, base).count() == items.count()


def test_upserts_of_stored_items_equal_upserts_of_batches(spark, sf_dir, tmp_path):
    existing = spark.createDataFrame([(1, P.SCRAPE_TIME, "Kept", 3, "{}", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1)),
                                      (2, "https://maps.example.com/?cid=2", "Old", 4, "{}", dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 2))], EMPTY)
    landing, items = _landed(spark, sf_dir, f"{tmp_path}/landing", range(1, 4))
    SJ.ingest_stream(spark, landing, f"{tmp_path}/stored", NOW)
    inc = P.combine_business(items)
    want = S.upsert(existing, inc.select(*[c for c in inc.columns if c in existing.columns or c == "scraped_at"]), "apify_place_id", NOW)
    assert _key(L.stored_businesses(spark, f"{tmp_path}/stored", existing)) == _key(want.select(*existing.columns))


def test_broken_lines_and_pretty_printed_arrays(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text('{"title": "A", "cid": "1"}\nnot json\n{"title": "B", "cid": \n\n{"title": 7, "rank": "no number"}\n')
    rows = materialize(L.read_landed(spark, str(tmp_path / "lines")), "lines")
    assert [(r.title, r.cid) for r in L.accepted_items(rows).collect()] == [("A", "1")]
    assert sorted(r.line for r in L.rejected_lines(rows).collect()) == ["not json", '{"title": "B", "cid": ', '{"title": 7, "rank": "no number"}']
    (tmp_path / "pretty").mkdir()
    (tmp_path / "pretty" / "a.json").write_text('[\n  {"title": "A",\n   "cid": "1"},\n  {"title": "B"}\n]')
    (tmp_path / "pretty" / "b.json").write_text('[\n  {"title": "C"')
    whole = materialize(L.read_landed(spark, str(tmp_path / "pretty"), multi_line=True), "pretty")
    assert sorted(r.title for r in L.accepted_items(whole).collect()) == ["A", "B"]
    assert [r.line for r in L.rejected_lines(whole).collect()] == ['[\n  {"title": "C"']
    base = str(tmp_path / "stored")
    SJ.ingest_stream(spark, str(tmp_path / "lines"), base, NOW)
    empty = spark.createDataFrame([], EMPTY)
    assert [r.business_name for r in L.stored_businesses(spark, base, empty).collect()] == ["A"]
    assert sorted(r.review_id for r in L.stored_reviews(spark, base, empty)[1].where("reason = 'corrupt_line'").collect()) == ["not json", '{"title": "B", "cid": ', '{"title": 7, "rank": "no number"}']


def test_merged_dimensions_hold_all_seven_of_each_item(spark, tmp_path, monkeypatch):
    """Empty texts and zeros are left out, as what is missing; an item without a name keeps its other fields."""
    dist = {"oneStar": 1, "twoStar": 0, "threeStar": 2, "fourStar": 3, "fiveStar": 4}
    full = {"title": 'Bob\'s "Café"', "categoryName": "Plumber", "searchString": "q", "url": "https://x/1", "city": "Tempe", "state": "AZ", "street": "1 Main", "postalCode": "85281", "countryCode": "US",
            "plusCode": "p+1", "isAdvertisement": True, "rank": 3, "searchPageUrl": "https://s/1", "totalScore": 4.5, "reviewsCount": 7, "reviewsDistribution": dist, "website": "https://b", "phone": "+1-5",
            "phoneUnformatted": "+15", "email": "a@b.c", "claimThisBusiness": True, "menu": "m", "temporarilyClosed": True, "permanentlyClosed": False, "facebookPages": "f", "instagrams": "i", "twitters": "t",
            "linkedIns": "l", "pinterests": "pi", "youtubes": "y", "popularTimesHistogram": {"Mo": [{"hour": 9, "occupancyPercent": 40}]}, "tags": ["a", "b"], "gadId": "g", "placeId": "p1", "cid": "1",
            "dataId": "d", "price": "$", "location": {"lat": 33.5, "lng": -112.25}, "scrapedAt": "2025-10-01T06:00:00", "reviews": []}
    bare = {"title": "", "url": "https://x/2", "rank": 0, "totalScore": 0.0, "reviewsCount": 0, "website": "", "scrapedAt": "2025-10-01T06:00:01", "reviews": []}
    path = str(tmp_path / "items")
    spark.createDataFrame([(json.dumps(x),) for x in (full, bare)], "value string").write.text(path)
    monkeypatch.setattr(R.W, "landed_places", lambda s, d: P.read_places(s, path))
    got = {r.apify_place_id: r for r in R.INGEST_QUERIES["merge_dimensions"](spark, "none").collect()}
    some = lambda *names: {k: full[k] for k in names}
    assert json.loads(got["https://x/1"].business_data) == {
        "overview": some("title", "searchString", "url", "city", "state", "street", "postalCode", "countryCode", "plusCode", "isAdvertisement", "rank", "searchPageUrl", "temporarilyClosed",
                         "permanentlyClosed") | {"category": "Plumber"},
        "contact": some("phone", "phoneUnformatted", "website", "email", "claimThisBusiness", "menu"),
        "social": some("facebookPages", "instagrams", "twitters", "linkedIns", "pinterests", "youtubes"),
        "rating": some("totalScore", "reviewsCount", "reviewsDistribution"), "popular_times": some("popularTimesHistogram"), "tags": ["a", "b"],
        "lead_enrichment": some("gadId", "placeId", "cid", "dataId", "price", "location"), "scraped_at": full["scrapedAt"]}
    off = {"isAdvertisement": False, "temporarilyClosed": False, "permanentlyClosed": False}
    assert json.loads(got["https://x/2"].business_data) == {"overview": {"url": "https://x/2"} | off, "contact": {"claimThisBusiness": False}, "social": {}, "rating": {}, "popular_times": {},
                                                            "lead_enrichment": {}, "scraped_at": bare["scrapedAt"]}
    assert (got["https://x/1"].rating, got["https://x/1"].review_count, got["https://x/1"].website, got["https://x/1"].phone) == (decimal.Decimal("4.5"), 7, "https://b", "+1-5")
    assert got["https://x/2"].business_name == "Unknown" and got["https://x/2"].review_count is None


def test_first_delivery_is_kept_over_restarts_folders_and_lost_checkpoints(spark, sf_dir, tmp_path):
    four = _four_files(spark, sf_dir, "orders", tmp_path)
    base = f"{tmp_path}/reviews"
    once = _key(SJ.review_stream(spark, sf_dir))
    assert _key(SJ.review_stream(spark, four, max_files=1, base=base)) == once
    assert _key(SJ.review_stream(spark, four, max_files=1, base=base)) == once                                 # a restart, nothing new
    assert _key(SJ.review_stream(spark, sf_dir, base=base)) == once                                            # the same reviews from another folder
    assert _key(SJ.review_stream(spark, four, base=base, checkpoint=f"{tmp_path}/lost")) == once
    larger = "/root/testdata/sf0.01"
    both = SJ.review_stream(spark, larger, base=base)                                                          # new rows beside known ones
    assert both.count() == spark.read.parquet(f"{larger}/orders.parquet").count()
    first = {tuple(r) for r in both.collect()}
    assert all(tuple(r) in first for r in once)


def test_totals_go_on_after_a_restart_and_refuse_another_query(spark, sf_dir, tmp_path):
    four = _four_files(spark, sf_dir, "orders", tmp_path)
    base = f"{tmp_path}/counters"
    want = _key(SJ.run_counter_stream(spark, sf_dir))
    assert _key(SJ.run_counter_stream(spark, four, max_files=1, base=base)) == want
    assert _key(SJ.run_counter_stream(spark, four, base=base)) == want
    os.remove(next(os.path.join(d, f) for d, _, fs in os.walk(f"{four}/orders.parquet") for f in fs if f.endswith(".parquet")))
    assert _key(SJ.run_counter_stream(spark, four, base=base)) == want                                         # taken files may go
    with pytest.raises(Exception, match="checkpoint"):
        SJ.run_counter_stream(spark, four, base=base, checkpoint=f"{tmp_path}/other")


def test_sliding_windows_in_state_equal_those_from_days(spark, sf_dir, tmp_path):
    four = _four_files(spark, sf_dir, "events", tmp_path)
    sliding = SJ.velocity_stream(spark, four, max_files=2, length="90 days", step="1 day")
    days = SJ.velocity_stream(spark, sf_dir)
    cols = ["window_start", "event_type", "events"]
    assert _key(sliding.select(*cols)) == _key(SJ.longer_windows(days, step=1).select(*cols))


def test_late_events_are_counted(spark, tmp_path):
    """With a delay, events for windows that the batch before had closed are dropped and told; without one none is."""
    schema = "ts timestamp_ntz, event_type string, value double"
    folder = f"{tmp_path}/events.parquet"
    days = [[1, 2, 3], [20, 21], [2, 22], [1, 23]]
    for k, own in enumerate(days):
        spark.createDataFrame([(dt.datetime(2025, 1, d, 5), "a", 1.0) for d in own], schema).coalesce(1).write.mode("append").parquet(folder)
        newest = max((os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")), key=os.path.getctime)
        os.utime(newest, (1_700_000_000 + k, 1_700_000_000 + k))
    base = f"{tmp_path}/late"
    kept = SJ.velocity_stream(spark, str(tmp_path), max_files=1, base=base, late="5 days").agg(F.sum("events")).first()[0]
    assert SJ.late_events(spark, base) == 1 and kept == 8
    assert SJ.velocity_stream(spark, str(tmp_path), max_files=1).agg(F.sum("events")).first()[0] == 9


def test_warnings_are_counted_in_the_writing_pass(spark, tmp_path):
    ext = spark.createDataFrame([(1, 7, 5, False, False), (2, 7, 99, False, False), (3, 7, None, True, False), (4, 7, None, False, True), (5, 8, -1, False, False)],
                                "id long, business_id long, stars int, bad_stars boolean, bad_date boolean")
    rows, counts, samples = S.append_observed(ext, str(tmp_path / "observed"))
    assert counts == {"reviews": 5, "bad_stars": 1, "bad_date": 1, "stars_out_of_range": 2}
    assert samples == {"bad_stars": (3, None), "bad_date": (4, None), "stars_out_of_range": (2, "99")}
    assert sorted(r.id for r in rows.collect()) == [1, 3, 4]
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "observed/accepted=false")).collect()) == [2, 5]


def test_distinct_rollup_equals_count_distinct(spark):
    from marketlens.operators.distinct_rollup import distinct_rollup
    df = spark.range(5000).select((F.col("id") % 7).cast("string").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("b"), (F.col("id") * 37 % 200_000).alias("k"))
    df = df.unionByName(df.limit(300)).unionByName(spark.createDataFrame([("0", 1, None), (None, None, -5)], "a string, b long, k long"))
    got = sorted(map(tuple, distinct_rollup(df, ["a", "b"], "k").collect()), key=repr)
    want = []
    for level, keys in ((2, ["a", "b"]), (1, ["a"]), (0, [])):
        want += [(level, r["a"] if level > 0 else None, r["b"] if level > 1 else None, r["n"]) for r in df.groupBy(*keys).agg(F.count_distinct("k").alias("n")).collect()]
    assert got == sorted(want, key=repr)
