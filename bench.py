"""Benchmark the headline models at $BENCH_SF_DIR on local[$BENCH_CPUS].

Setup (timed, reported under ``setup``): derive the three feeds from the
shared tables and write them as JSONL (the lake).  Each query then runs in
full (``noop`` sink: every row computed, nothing collected) from the JSONL
feeds, exactly as the checked queries do: one warm-up run, then the best of
$BENCH_REPEATS (default 2) timed runs.  The batch jobs (ingest, publish, load,
views, build) are timed once each without any cached fixture, under ``jobs``.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from feedloom.plans import jobs, registry  # noqa: E402
from feedloom.plans.fixtures import ingest_root, lake_root, pending_root  # noqa: E402
from feedloom.schemas import APPDETAILS, DATE_COLUMN, FEEDS, REVIEWS  # noqa: E402
from feedloom.session import get_session, scratch_dir  # noqa: E402
from feedloom.sources.derived import AS_OF, details_payloads, reviews_payloads  # noqa: E402
from feedloom.sources.feeds import feed_path, load_feed  # noqa: E402
from feedloom.sources.tables import replace_day  # noqa: E402

HEADLINE = ("latest_per_key", "stg_appdetails", "mart_appdetails", "mart_genres",
            "mart_details_reviews")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
OTHERS = ("latest_per_key_rank", "stg_catalog", "stg_reviews", "mart_categories",
          "mart_reviews", "pending_details", "run_counts", "ingest_details")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def time_jobs(spark, sf_dir: str) -> dict:
    """Each batch job once, from start to written output, into fresh folders."""
    took, lake, raw_at = {}, scratch_dir(spark, "bench-lake"), scratch_dir(spark, "bench-raw")

    def timed(name, f):
        t0 = time.time()
        f()
        took[name] = round(time.time() - t0, 3)

    for feed, payloads in ((APPDETAILS, details_payloads), (REVIEWS, reviews_payloads)):
        landed = scratch_dir(spark, "bench-landed")  # as a fetcher lands them: in several files
        payloads(spark, sf_dir).repartition(16).write.parquet(landed)
        timed(f"ingest_{feed}", lambda f=feed, at=landed: jobs.ingest(
            spark, spark.read.parquet(at), f, scratch_dir(spark, "bench-ingest"), AS_OF))
    timed("publish_day", lambda: jobs.publish_day(spark, lake_root(spark, sf_dir), lake, AS_OF))
    # the landed day file holds rows of about 2,400 days: a backfill
    timed("load_day_reviews_backfill", lambda: jobs.load_day(spark, lake, AS_OF, raw_at, (REVIEWS,)))
    # rows dated to seven days, loaded as one
    for feed in FEEDS:
        df = load_feed(spark, feed_path(lake, feed, AS_OF), feed)
        df = df.withColumn(DATE_COLUMN[feed], F.trunc(DATE_COLUMN[feed], "year"))
        timed(f"replace_day_{feed}", lambda d=df, f=feed: replace_day(d, raw_at + "-years", f, AS_OF))
    timed("load_tables_reviews_backfill", lambda: jobs.load_tables(
        spark, lake, AS_OF, raw_at + "-tables", "bench_tables", (REVIEWS,), buckets=2))
    timed("publish_views", lambda: jobs.publish_views(spark, raw_at + "-years", "bench_raw"))
    timed("build_all", lambda: jobs.build_all(spark, raw_at + "-years", "bench_marts", as_of=AS_OF,
                                              location=scratch_dir(spark, "bench-marts")))
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    setup = {}
    t0 = time.time()
    lake_root(spark, sf_dir)
    setup["write_feeds"] = round(time.time() - t0, 3)
    t0 = time.time()
    pending_root(spark, sf_dir)
    setup["write_history"] = round(time.time() - t0, 3)
    t0 = time.time()
    ingest_root(spark, sf_dir)
    setup["ingest_payloads"] = round(time.time() - t0, 3)

    names = list(HEADLINE) + [n for n in OTHERS if n not in HEADLINE]
    only = [a for a in sys.argv[1:] if a in registry.QUERIES]
    if only:
        names = only
    times = {}
    for name in names:
        fn = registry.QUERIES[name]
        run(fn(spark, sf_dir))  # warm: plan, JIT, file listing
        best = None
        for _ in range(REPEATS):
            t0 = time.time()
            run(fn(spark, sf_dir))
            dt = time.time() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    jobs_s = {} if only else time_jobs(spark, sf_dir)
    head = [times[n] for n in HEADLINE if n in times]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_models_total",
        "value": round(sum(head), 3),
        "unit": "sec",
        "queries": times,
        "setup": setup,
        "jobs": jobs_s,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
