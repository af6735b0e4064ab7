"""End-to-end jobs on hand-written feeds: publish → load → build."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feedloom.plans.jobs import build_all, load_day, publish_day
from feedloom.sources.feeds import feed_path, load_feed, read_catalog
from feedloom.sources.tables import raw, replace_day

from .helpers import details_raw, details_row, reviews_row, write_lines

DAY = "2024-01-02"


def _land(root: str, day: str = DAY) -> None:
    write_lines(feed_path(root, "steam_catalog", day),
                [{"partition_date": day, "appid": 1, "name": "A"},
                 {"partition_date": day, "appid": 2, "name": "B"}])
    write_lines(feed_path(root, "steam_appdetails", day), [
        details_row(1, day, raw=details_raw(
            genres=[{"id": "23", "description": "Indie"}],
            categories=[{"id": 1, "description": "Multi-player"}])),
        details_row(2, day, success=False)])
    write_lines(feed_path(root, "steam_reviews", day),
                [reviews_row(1, day, total=10, good=7), reviews_row(2, day, total=0, good=0)])


def test_publish_load_build(spark, tmp):
    src, lake, wh = (os.path.join(tmp, d) for d in ("local", "lake", "raw"))
    _land(src)
    publish_day(spark, src, lake, DAY)
    load_day(spark, lake, DAY, wh)
    built = build_all(spark, wh, out_db="feedloom_test", as_of="2024-06-30",
                      location=os.path.join(tmp, "marts"))
    ad = built["mart_steam_appdetails"].collect()
    assert [(r.appid, r.is_indie, r.is_multiplayer, r.is_very_indie) for r in ad] == \
        [(1, True, True, True)]
    assert built["mart_steam_genres"].count() == 1
    assert built["mart_steam_categories"].count() == 1
    dr = built["mart_steam_details_reviews"].collect()
    assert [(r.appid, r.good_review_ratio) for r in dr] == [(1, 0.7)]
    ratios = {r.appid: r.good_review_ratio for r in built["mart_steam_reviews"].collect()}
    assert ratios == {1: 0.7, 2: None}
    assert spark.table("stg_steam_catalog").count() == 2


def test_publish_needs_catalog_and_details(spark, tmp):
    src, lake = os.path.join(tmp, "local"), os.path.join(tmp, "lake")
    write_lines(feed_path(src, "steam_catalog", DAY), [{"appid": 1}])
    with pytest.raises(Exception):
        publish_day(spark, src, lake, DAY)
    assert not os.path.exists(feed_path(lake, "steam_catalog", DAY))


def test_missing_raw_table_raises_and_leaves_the_mart(spark, tmp):
    src, wh, marts_at = (os.path.join(tmp, d) for d in ("local", "raw", "marts"))
    _land(src)
    load_day(spark, src, DAY, wh)
    build_all(spark, wh, out_db="feedloom_kept", location=marts_at, select=["mart_steam_reviews"])
    with pytest.raises(AnalysisException):
        build_all(spark, wh + "x", out_db="feedloom_kept", location=marts_at,
                  select=["mart_steam_reviews"])
    assert spark.table("feedloom_kept.mart_steam_reviews").count() == 2


def test_one_mart_alone_parses_once(spark, tmp):
    src, wh = os.path.join(tmp, "local"), os.path.join(tmp, "raw")
    _land(src)
    load_day(spark, src, DAY, wh)
    build_all(spark, wh, out_db="feedloom_one", as_of="2024-06-30",
              location=os.path.join(tmp, "marts"), select=["mart_steam_genres"])
    plan = spark.table("stg_steam_appdetails")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "parquet" in plan
    assert spark.table("feedloom_one.mart_steam_genres").count() == 1


def test_a_bad_record_leaves_the_old_day_whole(spark, tmp):
    lake, wh = os.path.join(tmp, "lake"), os.path.join(tmp, "raw")
    write_lines(feed_path(lake, "steam_reviews", DAY), [reviews_row(1, DAY), reviews_row(2, DAY)])
    load_day(spark, lake, DAY, wh, feeds=("steam_reviews",))
    write_lines(feed_path(lake, "steam_reviews", DAY),
                [json.dumps(reviews_row(9, DAY)),
                 json.dumps(reviews_row(3, "2024-01-01")).replace("10", "3.7", 1),
                 '{"ingestion_date": "2024-01-01", "appid": "no number"}'])
    with pytest.raises(Exception):
        load_day(spark, lake, DAY, wh, feeds=("steam_reviews",))
    assert sorted(r.appid for r in raw(spark, wh, "steam_reviews").collect()) == [1, 2]


def test_a_day_has_one_spelling(spark, tmp):
    lake, wh = os.path.join(tmp, "lake"), os.path.join(tmp, "raw")
    write_lines(feed_path(lake, "steam_reviews", "2024-1-2"), [reviews_row(1, DAY)])
    for day in (DAY, "2024-1-2"):
        load_day(spark, lake, day, wh, feeds=("steam_reviews",))
    assert raw(spark, wh, "steam_reviews").count() == 1
    for bad in ("2024-13-01", "yesterday", "2024/01/02", ""):
        with pytest.raises(ValueError):
            load_day(spark, lake, bad, wh, feeds=("steam_reviews",))


def test_a_day_is_clustered_by_key(spark, tmp):
    df = spark.range(200_000).selectExpr(
        "date'2024-01-02' AS ingestion_date", "'s' AS source", "(id * 7919) % 200000 AS appid",
        "true AS success").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        replace_day(df, tmp, "steam_reviews", DAY)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    spans = (raw(spark, tmp, "steam_reviews").groupBy(F.input_file_name())
             .agg(F.min("appid").alias("lo"), F.max("appid").alias("hi")).orderBy("lo").collect())
    assert len(spans) > 1 and all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_bucketed_marts_join_without_shuffle(spark, tmp):
    src, lake, wh = (os.path.join(tmp, d) for d in ("local", "lake", "raw"))
    _land(src)
    publish_day(spark, src, lake, DAY)
    load_day(spark, lake, DAY, wh)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = build_all(spark, wh, out_db="feedloom_bucketed", as_of="2024-06-30",
                          location=os.path.join(tmp, "marts"), buckets=4)
        from feedloom.plans import marts
        j = marts.mart_details_reviews(built["mart_steam_appdetails"],
                                       built["mart_steam_reviews"])
        assert j.count() == 1
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_cli_runs_the_daily_steps(spark, tmp):
    from feedloom.__main__ import main

    src, lake, wh = (os.path.join(tmp, d) for d in ("local", "lake", "raw"))
    _land(src)
    assert main(["publish", "--src", src, "--lake", lake, "--date", DAY]) == 0
    assert main(["load", "--lake", lake, "--raw", wh, "--date", DAY]) == 0
    assert main(["build", "--raw", wh, "--db", "feedloom_cli", "--as-of", "2024-06-30",
                 "--select", "mart_steam_reviews",
                 "--location", os.path.join(tmp, "marts")]) == 0
    assert spark.table("feedloom_cli.mart_steam_reviews").count() == 2
    out = os.path.join(tmp, "pending")
    assert main(["pending", "--root", src, "--date", DAY, "--limit", "5", "--out", out]) == 0
    assert sorted(r.appid for r in spark.read.parquet(out).collect()) == [2]
    # the loaded raw table gives the same keys as the feed's files
    again = os.path.join(tmp, "pending-loaded")
    assert main(["pending", "--root", src, "--date", DAY, "--raw", wh, "--out", again]) == 0
    assert sorted(r.appid for r in spark.read.parquet(again).collect()) == [2]


def test_cli_shapes_landed_pages_and_payloads(spark, tmp):
    from feedloom.__main__ import main

    pages, payloads = os.path.join(tmp, "pages"), os.path.join(tmp, "payloads")
    spark.createDataFrame([(0, '{"response": {"apps": [{"appid": 7, "name": "Seven"}]}}')],
                          "page_no int, payload string").write.parquet(pages)
    spark.createDataFrame(
        [(7, '{"7": {"success": true, "data": {"name": "Seven", "type": "game"}}}', None),
         (8, None, "timeout")],
        "appid bigint, payload string, error string").write.parquet(payloads)
    assert main(["catalog", "--pages", pages, "--root", tmp, "--date", DAY]) == 0
    assert [(r.appid, r.name) for r in read_catalog(spark, tmp, DAY).collect()] == [(7, "Seven")]
    assert main(["ingest", "--payloads", payloads, "--root", tmp, "--date", DAY]) == 0
    feed = {r.appid: r.success for r in load_feed(
        spark, feed_path(tmp, "steam_appdetails", DAY), "steam_appdetails").collect()}
    assert feed == {7: True, 8: False}
    with pytest.raises(ValueError):
        main(["ingest", "--payloads", payloads, "--root", tmp, "--date", "2024-13-02"])
    # a raw table that was never created is no empty history
    with pytest.raises(AnalysisException):
        main(["pending", "--root", tmp, "--date", DAY, "--raw", os.path.join(tmp, "none"),
              "--out", os.path.join(tmp, "out")])
