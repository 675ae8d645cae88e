"""Benchmark the headline queries.

Runs each headline key on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: one warm-up, then the median of
``$BENCH_RUNS`` (default 3) timed runs.  Every run executes the whole plan
into Spark's ``noop`` sink (no collect to the driver).  The warm-up of the
first keys also derives and writes the stored market tables; every key's
first run is told under ``cold``.  Prints exactly one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlens.plans.registry import all_queries  # noqa: E402
from marketlens.session import get_session  # noqa: E402
from marketlens.sources.warehouse import clear_stored  # noqa: E402

HEADLINE = [
    "niche_opportunities", "customer_pain_points", "market_leaders", "vulnerable_players",
    "review_velocity_trends", "niche_service_gaps", "business_model_opportunities", "niche_swot_analysis",
    "business_summary", "recent_executions", "biz_by_city", "category_city_stats", "sentiment_by_category",
    "review_keyword_search", "fts_term", "fts_phrase", "theme_flags", "complaint_themes", "success_factors",
    "market_report", "market_entry", "upsert_businesses", "dq_report", "session_memory",
    "document_term_frequencies",
]
HEADLINE_ROUND_1 = len(HEADLINE)   # for totals that compare with the first round's
HEADLINE += [
    "document_search", "ingest_chain", "append_reviews", "stream_ingest_places",
    "stream_review_dedupe", "stream_run_counters", "stream_velocity_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "16g"})
    qs = all_queries()
    keys = only or HEADLINE
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for k in keys:
        def once():
            t0 = time.perf_counter()
            qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        cold[k] = round(once(), 4)
        times[k] = round(statistics.median(once() for _ in range(runs)), 4)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    out = {
        "metric": "headline_queries_total_median",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "value_of_round_1_keys": round(sum(times[k] for k in HEADLINE[:HEADLINE_ROUND_1] if k in times), 4),
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "cold": cold,
    }
    clear_stored(spark)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
