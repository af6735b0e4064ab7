"""Property checks and plan checks on the derived sf0.001 feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.latest import latest_per_key
from feedloom.plans import incremental, marts, staging
from feedloom.plans.fixtures import pending_root, raw_feed
from feedloom.schemas import APPDETAILS, CATALOG, REVIEWS
from feedloom.sources.derived import AS_OF, PENDING_RUN_DAY

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_form_equals_join_form(spark):
    for feed, date in ((APPDETAILS, "ingestion_date"), (REVIEWS, "ingestion_date"),
                       (CATALOG, "partition_date")):
        df = raw_feed(spark, SF, feed).drop("raw", "error_payload")
        a = latest_per_key(df, "appid", date, "join")
        b = latest_per_key(df, "appid", date, "rank")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pending_disjoint_from_processed_and_covers_catalog(spark):
    root = pending_root(spark, SF)
    cat = incremental.catalog_keys(spark, root, PENDING_RUN_DAY).select("appid")
    done = incremental.processed(spark, root, APPDETAILS)
    pend = incremental.pending(spark, root, APPDETAILS, PENDING_RUN_DAY).select("appid")
    assert pend.join(done, "appid").count() == 0
    assert cat.join(pend.unionByName(done), "appid", "left_anti").count() == 0


def test_genre_mart_rows_equal_genre_elements(spark):
    stg = staging.stg_appdetails(raw_feed(spark, SF, APPDETAILS))
    mart = marts.mart_appdetails(stg, AS_OF)
    genres = marts.mart_genres(stg, AS_OF)
    released = stg.join(mart.select("appid", "name").distinct(), ["appid", "name"])
    want = released.agg(F.sum(F.size("genres"))).first()[0] or 0
    assert genres.count() == want


def test_no_python_udf_in_models(spark):
    stg = staging.stg_appdetails(raw_feed(spark, SF, APPDETAILS))
    for df in (stg, marts.mart_genres(stg, AS_OF),
               marts.mart_details_reviews(marts.mart_appdetails(stg, AS_OF),
                                          marts.mart_reviews(staging.stg_reviews(
                                              raw_feed(spark, SF, REVIEWS))))):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_success_filter_pushed_to_scan(spark):
    stg = staging.stg_appdetails(raw_feed(spark, SF, APPDETAILS))
    df = stg.select("appid")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualNullSafe(success,true)" in plan or "PushedFilters: [EqualNullSafe" in plan


def test_materialized_staging_parses_json_once(spark):
    stg = staging.materialize(staging.stg_appdetails(raw_feed(spark, SF, APPDETAILS)))
    plan = _plan(marts.mart_genres(stg, AS_OF))
    assert "from_json" not in plan


def test_union_of_history_and_today_equals_one_scan(spark):
    from feedloom.operators.keys import processed_keys, union_processed
    from feedloom.sources.feeds import FEED_DAY, read_feed_history

    root = pending_root(spark, SF)
    hist = read_feed_history(spark, root, APPDETAILS)
    day = "1995-05-31"
    a = processed_keys(hist.filter(F.col(FEED_DAY) != day))
    b = processed_keys(hist.filter(F.col(FEED_DAY) == day))
    both = union_processed(a, b)
    one = incremental.processed(spark, root, APPDETAILS)
    assert both.exceptAll(one).count() == 0 and one.exceptAll(both).count() == 0


def test_day_filter_prunes_raw_table_folders(spark, tmp):
    from feedloom.operators.filters import on_day
    from feedloom.sources.tables import raw, replace_day

    df = spark.createDataFrame(
        [("2024-01-01", 1), ("2024-01-02", 2)], "d string, appid long").selectExpr(
        "cast(d as date) as ingestion_date", "'s' as source", "appid",
        "true as success", "10L as total_reviews")
    for day in ("2024-01-01", "2024-01-02"):
        replace_day(df.filter(F.col("ingestion_date") == day).select(
            "ingestion_date", "source", "appid", "success", "total_reviews"),
            tmp, REVIEWS, day)
    q = on_day(raw(spark, tmp, REVIEWS), "ingestion_date", "2024-01-02")
    assert [r.appid for r in q.collect()] == [2]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_hot_key_third_of_rows(spark):
    """One key holds a third of all rows, all on its latest day: both forms
    keep every tied row, and the join form never gathers the key's rows in a
    single-partition exchange."""
    n = 30000
    base = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS appid",
        "CASE WHEN id % 3 = 0 THEN date'2024-01-05' "
        "ELSE date_add(date'2024-01-01', CAST(id % 4 AS INT)) END AS ingestion_date",
        "CAST(id % 5 AS STRING) AS name")
    a = latest_per_key(base, "appid", "ingestion_date", "join")
    b = latest_per_key(base, "appid", "ingestion_date", "rank")
    assert a.filter("appid = 7").count() == n // 3
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    stg = a.select("appid", "name").distinct()
    assert stg.filter("appid = 7").count() == 5
    assert "SinglePartition" not in _plan(a)
