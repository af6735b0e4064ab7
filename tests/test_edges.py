"""Hand-written edge rows (FIXTURES.md §3), expected results worked out by hand."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from feedloom.plans import incremental, marts, staging
from feedloom.plans.jobs import ingest, load_day
from feedloom.plans.normalize import shape_details, shape_reviews
from feedloom.sources.feeds import (feed_path, load_feed, read_failed,
                                    read_feed_history, write_feed_day)
from feedloom.sources.tables import raw

from .helpers import details_raw, details_row, reviews_row, write_lines

AS_OF = "2024-06-30"


def _details(spark, tmp, rows):
    path = write_lines(os.path.join(tmp, "steam_appdetails", "steam_appdetails_x.jsonl"),
                       rows)
    return load_feed(spark, path, "steam_appdetails")


def _reviews(spark, tmp, rows):
    path = write_lines(os.path.join(tmp, "steam_reviews", "steam_reviews_x.jsonl"), rows)
    return load_feed(spark, path, "steam_reviews")


def test_01_failed_later_details_keep_earlier_success(spark, tmp):
    df = _details(spark, tmp, [
        details_row(1, "2024-01-01", raw=details_raw(), name="Old"),
        details_row(1, "2024-01-02", success=False)])
    out = staging.stg_appdetails(df).collect()
    assert [(r.appid, r.name) for r in out] == [(1, "Old")]


def test_02_failed_later_reviews_hide_metrics(spark, tmp):
    df = _reviews(spark, tmp, [reviews_row(1, "2024-01-01"),
                               reviews_row(1, "2024-01-02", success=False)])
    out = staging.stg_reviews(df).collect()
    assert len(out) == 1 and out[0].total_reviews is None and out[0].good_reviews is None


def test_03_failed_and_good_same_day_fan_out(spark, tmp):
    rv = _reviews(spark, tmp, [reviews_row(1, "2024-01-02"),
                               reviews_row(1, "2024-01-02", success=False)])
    stg = staging.stg_reviews(rv)
    assert stg.count() == 2
    ad = _details(spark, os.path.join(tmp, "d"),
                  [details_row(1, "2024-01-01", raw=details_raw())])
    mart = marts.mart_details_reviews(
        marts.mart_appdetails(staging.stg_appdetails(ad), AS_OF), marts.mart_reviews(stg))
    assert mart.count() == 2


def test_04_identical_rows_on_latest_day_collapse(spark, tmp):
    r = details_row(1, "2024-01-02", raw=details_raw())
    assert staging.stg_appdetails(_details(spark, tmp, [r, r])).count() == 1


def test_05_null_key_or_date_dropped(spark, tmp):
    df = _details(spark, tmp, [details_row(None, "2024-01-02", raw=details_raw()),
                               details_row(2, None, raw=details_raw())])
    assert staging.stg_appdetails(df).count() == 0


def test_06_quoted_and_numeric_ids_become_long(spark, tmp):
    raw_obj = details_raw(genres=[{"id": "23", "description": "Indie"}],
                          categories=[{"id": 1, "description": "Multi-player"}])
    row = staging.stg_appdetails(_details(spark, tmp, [
        details_row(1, "2024-01-01", raw=raw_obj)])).first()
    assert row.genres[0].id == 23 and row.categories[0].id == 1


@pytest.mark.parametrize("genres", ["absent", None, []])
def test_07_missing_genres_are_empty(spark, tmp, genres):
    raw_obj = details_raw()
    if genres == "absent":
        raw_obj.pop("genres")
    else:
        raw_obj["genres"] = genres
    stg = staging.stg_appdetails(_details(spark, tmp, [details_row(1, "2024-01-01",
                                                                    raw=raw_obj)]))
    assert stg.first().genres == []
    assert marts.mart_genres(stg, AS_OF).count() == 0


def test_08_genre_without_description_is_not_indie(spark, tmp):
    raw_obj = details_raw(genres=[{"id": "23"}])
    stg = staging.stg_appdetails(_details(spark, tmp, [details_row(1, "2024-01-01",
                                                                    raw=raw_obj)]))
    assert marts.mart_appdetails(stg, AS_OF).first().is_indie is False


def _mart_row(spark, tmp, **raw_kw):
    stg = staging.stg_appdetails(_details(spark, tmp, [
        details_row(1, "2024-01-01", raw=details_raw(**raw_kw))]))
    return marts.mart_appdetails(stg, AS_OF).first()


def test_09_both_empty_is_self_published(spark, tmp):
    assert _mart_row(spark, tmp, developers=(), publishers=()).is_self_published is True


def test_10_absent_developers(spark, tmp):
    r = _mart_row(spark, tmp, developers=None,
                  genres=[{"id": "23", "description": "Indie"}])
    assert r.is_self_published is None and r.is_very_indie is False


def test_11_order_matters(spark, tmp):
    r = _mart_row(spark, tmp, developers=("A", "B"), publishers=("B", "A"))
    assert r.is_self_published is False


@pytest.mark.parametrize("text", ["Mar 5, 2020", "Mar 05, 2020", "mar 5, 2020",
                                  " Mar  5, 2020 ", "March 5, 2020"])
def test_12_release_dates_parse(spark, tmp, text):
    assert _mart_row(spark, tmp, date=text).cleaned_release_date == dt.date(2020, 3, 5)


@pytest.mark.parametrize("text", ["Q1 2025", "2024", "5 Mar, 2020", "Feb 30, 2020", "",
                                  "Coming soon", None, "Mar 5 2020", "Marc 5, 2020"])
def test_13_bad_release_dates_filtered(spark, tmp, text):
    assert _mart_row(spark, tmp, date=text) is None


def test_14_as_of_boundary(spark, tmp):
    stg = staging.stg_appdetails(_details(spark, tmp, [
        details_row(1, "2024-01-01", raw=details_raw(date="Jun 30, 2024")),
        details_row(2, "2024-01-01", raw=details_raw(date="Jul 1, 2024"))]))
    assert [r.appid for r in marts.mart_appdetails(stg, AS_OF).collect()] == [1]


def test_15_ratio_null_for_zero_or_null(spark, tmp):
    df = _reviews(spark, tmp, [reviews_row(1, "2024-01-01", total=0, good=0),
                               reviews_row(2, "2024-01-01", total=None, good=3),
                               reviews_row(3, "2024-01-01", total=4, good=1)])
    got = {r.appid: r.good_review_ratio
           for r in marts.mart_reviews(staging.stg_reviews(df)).collect()}
    assert got == {1: None, 2: None, 3: 0.25}


def test_16_malformed_lines(spark, tmp):
    write_lines(feed_path(tmp, "steam_appdetails", "2024-01-01"),
                ['not json', '{"appid": 5, "success": true}'])
    keys = incremental.processed(spark, tmp, "steam_appdetails").collect()
    assert [r.appid for r in keys] == [5]
    write_lines(feed_path(tmp, "steam_catalog", "2024-01-02"),
                ['{"appid": 5}', 'not json'])
    with pytest.raises(Exception):
        incremental.catalog_keys(spark, tmp, "2024-01-02").collect()


def test_17_quoted_history_key(spark, tmp):
    write_lines(feed_path(tmp, "steam_appdetails", "2024-01-01"),
                ['{"appid": "2", "success": true}', '{"appid": 3, "success": false}',
                 '{"appid": 4}'])
    assert [r.appid for r in incremental.processed(spark, tmp, "steam_appdetails")
            .collect()] == [2]


def test_17b_keys_and_flags_by_json_type(spark, tmp):
    write_lines(feed_path(tmp, "steam_appdetails", "2024-01-01"),
                ['{"appid": 5.0, "success": true}', '{"appid": 6, "success": "false"}',
                 '{"appid": 7, "success": "0"}', '{"appid": 8, "success": ""}',
                 '{"appid": 9, "success": 0}', '{"appid": 10, "success": 1}',
                 '{"appid": 11, "success": []}', '{"appid": 12, "success": {"a": 1}}',
                 '{"appid": null, "success": true}', '{"appid": 13, "success": null}'])
    got = sorted(r.appid for r in incremental.processed(spark, tmp, "steam_appdetails").collect())
    assert got == [5, 6, 7, 10, 12]


def test_17c_repeated_keys_and_odd_values_in_payloads(spark, tmp):
    ingest(spark, spark.createDataFrame([
        (1, '{"1": {"success": false, "success": true, "data": {"name": "a", "name": "b"}}}', None),
        (2, '{"2": {"success": "no", "data": {"name": "c"}}}', None),
        (3, '{"3": {"success": 0, "data": {"name": "d"}}}', None)],
        "appid long, payload string, error string"), "steam_appdetails", tmp, "2024-01-02", "t")
    rows = {r.appid: r for r in load_feed(
        spark, feed_path(tmp, "steam_appdetails", "2024-01-02"), "steam_appdetails").collect()}
    assert [(rows[k].success, rows[k].name) for k in (1, 2, 3)] == [
        (True, "b"), (True, "c"), (False, None)]
    ingest(spark, spark.createDataFrame(
        [(1, '{"success": 1, "query_summary": {"total_reviews": 3.7}}', None)],
        "appid long, payload string, error string"), "steam_reviews", tmp, "2024-01-02", "t")
    with pytest.raises(Exception):  # not cut to 3
        load_feed(spark, feed_path(tmp, "steam_reviews", "2024-01-02"), "steam_reviews").collect()


def test_18_catalog_order_and_limit(spark, tmp):
    write_lines(feed_path(tmp, "steam_catalog", "2024-01-02"),
                [{"appid": a} for a in (50, 7, 50, 3, 7, 9)])
    got = incremental.pending(spark, tmp, "steam_appdetails", "2024-01-02", limit=3)
    assert [r.appid for r in got.collect()] == [50, 7, 3]


def test_18b_latest_catalog_fallback(spark, tmp):
    write_lines(feed_path(tmp, "steam_catalog", "2024-01-01"), [{"appid": 1}])
    write_lines(feed_path(tmp, "steam_catalog", "2024-01-05"), [{"appid": 2}])
    got = incremental.catalog_keys(spark, tmp, "2024-01-03").collect()
    assert [r.appid for r in got] == [2]


def test_19_replace_day_idempotent_and_empty(spark, tmp):
    lake = os.path.join(tmp, "lake")
    wh = os.path.join(tmp, "raw")
    day = "2024-01-02"
    for feed, rows in (("steam_catalog", [{"partition_date": day, "appid": 1, "name": "A"}]),
                       ("steam_appdetails", [details_row(1, day, raw=details_raw())]),
                       ("steam_reviews", [reviews_row(1, day), reviews_row(2, day)])):
        write_lines(feed_path(lake, feed, day), rows)
    load_day(spark, lake, day, wh)
    load_day(spark, lake, day, wh)
    assert raw(spark, wh, "steam_reviews").count() == 2
    assert raw(spark, wh, "steam_catalog").count() == 1
    write_lines(feed_path(lake, "steam_reviews", day), [])
    load_day(spark, lake, day, wh, feeds=("steam_reviews",))
    assert raw(spark, wh, "steam_reviews").count() == 0
    assert raw(spark, wh, "steam_appdetails").filter(
        F.col("ingestion_date") == day).count() == 1


def test_19b_other_day_rows_are_appended(spark, tmp):
    lake, wh, day = os.path.join(tmp, "lake"), os.path.join(tmp, "raw"), "2024-01-02"
    write_lines(feed_path(lake, "steam_reviews", day),
                [reviews_row(1, day), reviews_row(2, "2024-01-01")])
    load_day(spark, lake, day, wh, feeds=("steam_reviews",))
    got = sorted((r.appid, str(r.ingestion_date))
                 for r in raw(spark, wh, "steam_reviews").collect())
    assert got == [(1, day), (2, "2024-01-01")]


def test_20_unknown_field_ignored(spark, tmp):
    df = _details(spark, tmp, [details_row(1, "2024-01-01", raw=details_raw(), extra=5)])
    assert df.count() == 1 and "extra" not in df.columns


def _payloads(spark, rows):
    return spark.createDataFrame(rows, "appid bigint, payload string, error string")


def test_21_22_23_details_payload_forms(spark, tmp):
    rows = [(1, "null", None), (2, "[]", None),
            (3, '{"3": {"success": true, "data": null}}', None),
            (4, '{"4": {"success": true, "data": []}}', None),
            (5, '{"9": {"success": true, "data": {}}}', None),
            (6, '{"6": {"success": false}}', None),
            (7, '{"7": {"success": true}}', None),
            (8, None, "timeout"),
            (10, '{"10": {"success": true, "data": {"name": "Ten", "type": "game", '
                 '"genres": [{"id": "1", "description": "Action"}], "junk": 1}}}', None)]
    ingest(spark, _payloads(spark, rows), "steam_appdetails", tmp, "2024-01-01",
           "2024-01-01T00:00:00+00:00")
    feed = {r.appid: r for r in load_feed(
        spark, feed_path(tmp, "steam_appdetails", "2024-01-01"), "steam_appdetails").collect()}
    failed = sorted(r.appid for r in read_failed(spark, tmp, "steam_appdetails",
                                                 "2024-01-01").collect())
    assert failed == [1, 2, 3, 4, 8]
    for k in (1, 2, 3, 4, 8):
        assert feed[k].success is False and '"error"' in feed[k].error_payload
    assert feed[5].success is False and feed[5].error_payload == "{}"
    assert feed[6].success is False and '"success":false' in feed[6].error_payload
    assert feed[7].success is True and feed[7].raw.count("null") == 15
    assert feed[10].success is True and feed[10].name == "Ten"
    assert '"junk"' not in feed[10].raw and '"Action"' in feed[10].raw


def test_24_review_success_values(spark):
    rows = [(1, '{"success": 1, "query_summary": {"total_reviews": 4}}', None),
            (2, '{"success": true}', None), (3, '{"success": 2}', None),
            (4, '{"success": "1"}', None), (5, '{"success": 1.0}', None)]
    got = {r.appid: r.success for r in shape_reviews(_payloads(spark, rows), "2024-01-01")
           .collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: True}


def test_25_non_ascii_round_trip(spark, tmp):
    name = "Ōkami — 大神 ✓"
    df = shape_details(_payloads(spark, [
        (1, '{"1": {"success": true, "data": {"name": "%s"}}}' % name, None)]),
        "2024-01-01", "x")
    write_feed_day(df.drop("failed"), tmp, "steam_appdetails", "2024-01-01")
    back = load_feed(spark, feed_path(tmp, "steam_appdetails", "2024-01-01"),
                     "steam_appdetails").first()
    assert back.name == name and name in back.raw


def test_history_excludes_day(spark, tmp):
    write_lines(feed_path(tmp, "steam_reviews", "2024-01-01"),
                ['{"appid": 1, "success": true}'])
    write_lines(feed_path(tmp, "steam_reviews", "2024-01-02"),
                ['{"appid": 2, "success": true}'])
    hist = read_feed_history(spark, tmp, "steam_reviews", exclude_day="2024-01-02")
    assert [int(r.appid) for r in hist.collect()] == [1]
    write_lines(feed_path(tmp, "steam_catalog", "2024-01-02"),
                [{"appid": a} for a in (1, 2, 3)])
    c = incremental.run_counts(spark, tmp, "steam_reviews", "2024-01-02").first()
    assert (c.catalog_keys, c.historic_processed, c.today_processed, c.pending_keys) == \
        (3, 1, 1, 1)


def test_read_feed_day_missing_is_empty_and_stamp_is_utc(spark, tmp):
    from feedloom.sources.feeds import read_feed_day

    assert read_feed_day(spark, tmp, "steam_reviews", "2024-01-01").count() == 0
    write_lines(feed_path(tmp, "steam_reviews", "2024-01-01"),
                ['{"appid": 1, "success": true}', 'oops'])
    assert read_feed_day(spark, tmp, "steam_reviews", "2024-01-01").count() == 1
    stamp = shape_reviews(_payloads(spark, [(1, '{"success": 1}', None)]),
                          "2024-01-01").first().ingested_at
    assert stamp.endswith("+00:00") and stamp[10] == "T"


def test_catalog_pages_missing_apps_and_bad_page(spark, tmp):
    from feedloom.plans.normalize import catalog_from_pages

    pages = spark.createDataFrame(
        [(1, '{"response": {"apps": [{"appid": 5, "name": "E"}, {"appid": 3}]}}'),
         (2, '{"response": {}}'), (3, '{}'),
         (0, '{"response": {"apps": [{"appid": 9, "name": "N", "last_modified": 7}]}}')],
        "page_no int, payload string")
    got = [(r.appid, r.name, r.last_modified) for r in
           catalog_from_pages(pages, "2024-01-01").collect()]
    assert got == [(9, "N", 7), (5, "E", None), (3, None, None)]
    bad = spark.createDataFrame([(1, "not json")], "page_no int, payload string")
    with pytest.raises(Exception):
        catalog_from_pages(bad, "2024-01-01").collect()


def test_default_as_of_is_utc_today(spark):
    from datetime import datetime, timezone

    from feedloom.functions.flags import as_of_date

    got = spark.range(1).select(as_of_date(None).alias("d")).first().d
    assert got == datetime.now(timezone.utc).date()


def test_catalog_order_survives_file_splits(spark, tmp):
    """One catalog file read as many splits keeps first-seen order."""
    keys = [(i * 7919) % 20011 for i in range(20000)]
    keys = keys + keys[:500]          # repeats later in the file
    write_lines(feed_path(tmp, "steam_catalog", "2024-01-02"),
                [{"appid": k, "name": "x" * 40} for k in keys])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        cat = incremental.catalog_keys(spark, tmp, "2024-01-02")
        got = [r.appid for r in cat.orderBy("pos").collect()]
        top = incremental.pending(spark, tmp, "steam_appdetails", "2024-01-02", limit=50)
        assert [r.appid for r in top.collect()] == list(dict.fromkeys(keys))[:50]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(dict.fromkeys(keys))


def test_json_scalar_masks_only_whole_objects_and_arrays(spark):
    from feedloom.functions.json_fields import json_scalar

    rows = [("plain",), ("[TBA] soon",), ('{"a": 1}',), ("[1, 2]",), ("{broken",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(json_scalar(F.col("t")).alias("v"))
    assert [r.v for r in df.collect()] == ["plain", "[TBA] soon", None, None, "{broken", None]
