"""Disk and memory of feeds, loads and ingests: what is written, shuffled and parsed."""

from __future__ import annotations

import json
import os
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedloom.operators import latest
from feedloom.operators.latest import latest_per_key
from feedloom.plans import fixtures, jobs
from feedloom.schemas import APPDETAILS, CATALOG, REVIEWS
from feedloom.session import DROP_SHUFFLES, shuffles_dropped
from feedloom.sources.derived import AS_OF, catalog_feed, details_feed
from feedloom.sources import tables as tables_module
from feedloom.sources.feeds import feed_path, load_feed, read_failed, write_feed_day
from feedloom.sources.tables import conform, raw, replace_day

DAY = "2024-01-02"


def files(folder: str) -> list[str]:
    return [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if f.startswith("part-")]


@pytest.fixture()
def tables(spark, tmp):
    """lineitem, part and orders: repeated rows, missing parts, null keys and days."""
    def ship(d):
        return datetime(1995, 1, d) if d else None

    li = [(o, p, 1, n, 30.0, "N", "O", ship(d)) for o, p, n, d in (
        (1, 1, 1, 5), (1, 1, 2, 5), (1, 2, 3, 6), (2, 1, 1, 4), (2, None, 2, 4), (3, 9, 1, 4), (3, 2, 1, None), (9, 2, 2, 7))]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                              "l_returnflag string, l_linestatus string, l_shipdate timestamp") \
        .write.parquet(f"{tmp}/lineitem.parquet")
    parts = [(1, "red one"), (1, "red one"), (1, "other one"), (2, None), (3, "unused")]
    spark.createDataFrame([(k, n, "B", "T", 1.0) for k, n in parts],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double") \
        .write.parquet(f"{tmp}/part.parquet")
    spark.createDataFrame([(k, datetime(1995, 1, 1)) for k in (1, 2, 2, 3)], "o_orderkey long, o_orderdate timestamp") \
        .write.parquet(f"{tmp}/orders.parquet")
    return tmp


def test_feed_lines_take_a_small_part_of_their_text(spark, tmp):
    rows = spark.range(5000).select(
        F.lit("2024-01-02").alias("ingested_at_utc"), F.lit(date(2024, 1, 2)).alias("partition_date"),
        F.lit("s").alias("source"), F.col("id").alias("appid"), F.concat(F.lit("Spiel é "), "id").alias("name"),
        F.lit(None).cast("long").alias("last_modified"), F.lit(None).cast("long").alias("price_change_number"),
        F.to_json(F.struct("id")).alias("raw"))
    path = write_feed_day(rows, tmp, CATALOG, DAY)
    text = spark.read.text(path)
    assert sum(map(os.path.getsize, files(path))) < text.select(F.sum(F.octet_length("value") + 1)).first()[0] / 5
    got = load_feed(spark, path, CATALOG)
    assert sorted(got.select("appid", "name", "raw").collect()) == sorted(rows.select("appid", "name", "raw").collect())


def test_only_the_named_feeds_are_written(spark, tables):
    root = fixtures.lake_root(spark, tables, APPDETAILS)
    assert os.listdir(root.removeprefix("file:")) == [APPDETAILS]
    assert fixtures.lake_root(spark, tables, CATALOG) == root
    assert sorted(os.listdir(root.removeprefix("file:"))) == [APPDETAILS, CATALOG]
    assert load_feed(spark, feed_path(root, APPDETAILS, AS_OF), APPDETAILS).count() \
        == details_feed(spark, tables).count() == 14


def test_catalog_rows_are_distinct_and_ordered(spark, tables):
    rows = catalog_feed(spark, tables, ordered=True).select("partition_date", "appid", "name", "raw.name")
    got = [tuple(r) for r in rows.collect()]
    days = [d and date(1995, 1, d) for d in (None, 4, 4, 5, 5, 6, 7)]
    assert [(d, k) for d, k, *_ in got] == list(zip(days, (2, 1, 1, 1, 1, 2, 2)))
    assert sorted(map(str, got)) == sorted(str((d, k, n, n)) for d, k, n in zip(
        days, (2, 1, 1, 1, 1, 2, 2), (None, "red one", "other one", "red one", "other one", None, None)))


def test_names_are_not_hashed_a_row_a_line(spark, tables):
    """The distinct over lines groups by part and day alone; the sort does not carry the object."""
    plan = catalog_feed(spark, tables, ordered=True)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        assert not ("Aggregate" in line and "p_name" in line and "partition_date" in line), plan
    lines = [x.lstrip(" :+-") for x in plan.splitlines()]
    assert lines[0].startswith("Project") and lines[1].startswith("Sort") and "raw" not in "".join(lines[1:])


def test_shuffle_files_go_with_the_write(spark, tables, tmp_path):
    shuffles = {b.split("_")[1] for b in blocks(spark)}
    write_feed_day(details_feed(spark, tables).repartition(3, "appid"), str(tmp_path), APPDETAILS, DAY)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    with shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
    assert spark.conf.get(DROP_SHUFFLES) == before
    replace_day(load_feed(spark, feed_path(str(tmp_path), APPDETAILS, DAY), APPDETAILS), f"{tmp_path}/raw", APPDETAILS, DAY)
    assert {b.split("_")[1] for b in blocks(spark)} <= shuffles
    assert raw(spark, f"{tmp_path}/raw", APPDETAILS).count() == 14


def blocks(spark) -> list[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().iterator()
    out = []
    while found.hasNext():
        name = found.next().name()
        if name.startswith("shuffle_"):
            out.append(name)
    return out


@pytest.mark.parametrize("alike", [False, True])
def test_failed_keys_come_from_the_written_lines(spark, tmp, monkeypatch, alike):
    """A refusal whose block has an ``error`` is no failure; only then payloads are parsed again."""
    rows = [(1, '{"1": {"success": true, "data": {"name": "a"}}}', None), (2, "null", None), (3, None, "HTTP 503"),
            (4, '{"4": {"success": false}}', None), (8, "[]", None), (6, '{"6": {"success": true, "data": []}}', ""),
            (7, '{"7": {"success": true, "data": null}}', None)]
    rows += [(5, '{"5": {"success": false, "error": "refused"}}', None)] * alike
    read = []
    monkeypatch.setattr(jobs, "written_failures", lambda s, p, f=jobs.written_failures: read.append(p) or f(s, p))
    payloads = spark.createDataFrame(rows, "appid long, payload string, error string")
    paths = jobs.ingest(spark, payloads, APPDETAILS, tmp, DAY)
    lines = spark.read.option("recursiveFileLookup", "true").text(paths["failed"])
    assert sorted(r.value for r in lines.collect()) == ["2", "3", "6", "7", "8"]
    assert len(read) == (not alike)


def test_a_finished_ingest_is_not_parsed_again(spark, tmp, monkeypatch):
    rows = [(k, json.dumps({"success": 1}) if k % 2 else "null", None) for k in range(1, 6)]
    payloads = spark.createDataFrame(rows, "appid long, payload string, error string")
    first = jobs.ingest(spark, payloads, REVIEWS, tmp, DAY, batch="b")
    monkeypatch.setattr(jobs, "write_failed", lambda *a, **b: pytest.fail("written again"))
    assert jobs.ingest(spark, payloads, REVIEWS, tmp, DAY, batch="b") == first
    assert sorted(r.appid for r in read_failed(spark, tmp, REVIEWS, DAY).collect()) == [2, 4]


def test_gzip_level_of_feed_lines(spark, tmp):
    """Lines take less than at the fastest level of gzip."""
    rows = spark.range(20000).select(
        F.lit("2024-01-02").alias("ingested_at_utc"), F.lit(date(2024, 1, 2)).alias("partition_date"),
        F.lit("s").alias("source"), F.col("id").alias("appid"), F.sha2(F.col("id").cast("string"), 256).alias("name"),
        (F.col("id") * 7919 % 1000).alias("last_modified"), (F.col("id") % 13).alias("price_change_number"),
        F.to_json(F.struct("id")).alias("raw")).coalesce(1)
    path = write_feed_day(rows, tmp, CATALOG, DAY)
    spark.read.text(path).coalesce(1).write.option("zlib.compress.level", "BEST_SPEED").text(f"{tmp}/fast", compression="gzip")
    assert sum(map(os.path.getsize, files(path))) < .95 * sum(map(os.path.getsize, files(f"{tmp}/fast")))


def test_buckets_grow_with_the_feed(spark, tables, monkeypatch):
    """Tables of the catalog are read by key in tasks of bounded size, with the same rows."""
    from feedloom.plans import registry
    from feedloom.sources import warehouse

    spark.createDataFrame([(k, k % 3 if k < 9 else None, s, 10.0 * k, datetime(1995 + k % 3, 1, 1)) for k in range(1, 12) for s in "OF"],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp") \
        .withColumn("o_orderpriority", F.lit("1-URGENT")).write.mode("overwrite").parquet(f"{tables}/orders.parquet")
    size = 120
    monkeypatch.setattr(warehouse, "BUCKET_BYTES", size)
    db = fixtures.views_db(spark, tables)
    lake = fixtures.lake_root(spark, tables)
    for feed in (APPDETAILS, REVIEWS, CATALOG):
        lines = sum(map(os.path.getsize, files(feed_path(lake, feed, AS_OF).removeprefix("file:"))))
        n = warehouse.table_buckets(spark, f"{db}.{feed}")
        assert n == -(-lines // size) > 1

    def rows(df):
        return sorted(map(str, df.collect()))

    for name, same in (("stg_appdetails_ties", "stg_appdetails"), ("view_stg_appdetails", "stg_appdetails"),
                       ("stg_reviews_ties", "stg_reviews"), ("view_stg_reviews", "stg_reviews"),
                       ("stg_catalog_ties", "stg_catalog"), ("bucketed_stg_catalog", "stg_catalog"),
                       ("build_all_genres", "mart_genres")):
        assert rows(registry.QUERIES[name](spark, tables)) == rows(registry.QUERIES[same](spark, tables)), name
    dated = details_feed(spark, tables).filter("ingestion_date IS NOT NULL")  # both loads are of dated rows
    assert registry.QUERIES["table_raw_details"](spark, tables).count() == dated.count() > 0


def shuffled(spark) -> int:
    """Bytes of the shuffle files that are on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    out = 0
    while found.hasNext():
        f = found.next()
        if f.getName().startswith("shuffle_"):
            out += f.length()
    return out


def history(spark, keys: int, days: int):
    """A row a key and day, with wide text that does not compress; keys and days may be null."""
    rows = spark.range(keys * days).select(
        F.when(F.col("id") % 997 != 3, F.col("id") % keys).alias("appid"),
        F.when(F.col("id") % 991 != 5, F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") / keys).cast("int")))
        .alias("ingestion_date"),
        F.concat(*[F.sha2(F.concat("id", F.lit(f"-{k}")), 512) for k in range(4)]).alias("raw"))
    return rows.unionByName(rows.where("id % 50 = 0")).repartition(4)


def test_rows_of_earlier_days_are_not_shuffled(spark, tmp):
    """Of the wide rows about the latest alone go to the join."""
    history(spark, 100, 200).write.parquet(f"{tmp}/rows")
    rows = spark.read.parquet(f"{tmp}/rows")
    wide = rows.select(F.sum(F.length("raw"))).first()[0]
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled(spark)
        latest_per_key(rows).write.parquet(f"{tmp}/latest")
        assert shuffled(spark) - before < wide / 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


@pytest.mark.parametrize("words", [1, 7, latest.WORDS])
def test_hash_filter_loses_no_row(spark, tmp, monkeypatch, words):
    """However full the filter is, the join after it gives the rows of the rank form."""
    monkeypatch.setattr(latest, "WORDS", words)
    history(spark, 30, 20).write.parquet(f"{tmp}/rows")
    rows = spark.read.parquet(f"{tmp}/rows")
    got, want = (Counter(map(tuple, latest_per_key(rows, method=m).collect())) for m in ("join", "rank"))
    assert got == want and len(got) >= 30


def test_feeds_of_several_tables_are_written_in_slices(spark, tables, monkeypatch):
    """Shuffles of one slice of keys at a time are on disk."""
    written = []
    monkeypatch.setattr(fixtures, "write_feed_day", lambda df, *a, f=write_feed_day: written.append(df.count()) or f(df, *a))
    root = fixtures.lake_root(spark, tables, APPDETAILS)
    assert len(written) == fixtures.SLICES and max(written) < sum(written) == 14
    got = load_feed(spark, feed_path(root, APPDETAILS, AS_OF), APPDETAILS)
    columns = ["appid", "ingestion_date", "success", "name"]
    assert Counter(map(tuple, got.select(columns).collect())) \
        == Counter(map(tuple, details_feed(spark, tables).select(columns).collect()))


def test_history_of_the_pending_run_needs_no_whole_feed(spark, tables):
    """the rows come from the run's earlier files; the whole feed is not written beside them."""
    root = fixtures.pending_raw_root(spark, tables)
    assert fixtures._key(spark, tables, f"lake: {APPDETAILS}") not in fixtures._WRITTEN
    want = details_feed(spark, tables).filter(F.col("ingestion_date") < F.lit(fixtures.PENDING_RUN_DAY).cast("date"))
    columns = ["appid", "ingestion_date", "success", "name"]
    assert Counter(map(tuple, raw(spark, root, APPDETAILS).select(columns).collect())) \
        == Counter(map(tuple, want.select(columns).collect())) and want.count()


def reviews(spark, days: int, total: int):
    """Two rows a day (and without a day) in the raw schema's main columns."""
    rows = spark.range(2 * days).select(
        F.col("id").alias("appid"), F.when(F.col("id") > 1, F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") / 2).cast("int")))
        .alias("ingestion_date"), F.lit(total).cast("long").alias("total_reviews"))
    return conform(rows, REVIEWS)


def loaded(spark, root: str) -> Counter:
    return Counter(map(tuple, raw(spark, root, REVIEWS).select("appid", "ingestion_date", "total_reviews").collect()))


def test_days_are_sorted_in_slices(spark, tmp, monkeypatch):
    """A slice's staged rows go when it is written; all days get their rows."""
    scratch, left = f"{tmp}/staged", []
    monkeypatch.setattr(tables_module, "scratch_dir", lambda *a: scratch)
    monkeypatch.setattr(tables_module, "shuffles_dropped",
                        lambda s, f=shuffles_dropped: left.append(len([x for x in os.listdir(scratch) if x.startswith("slice=")])) or f(s))
    day, first, again = "2024-01-09", reviews(spark, 60, 1), reviews(spark, 61, 2)
    replace_day(first, f"{tmp}/raw", REVIEWS, day)
    assert left == list(range(len(left), 0, -1)) and len(left) > 4
    assert not os.path.exists(scratch) and all("=" in x for x in os.listdir(f"{tmp}/raw/{REVIEWS}") if not x.startswith("."))
    columns = ["appid", "ingestion_date", "total_reviews"]
    want = Counter(map(tuple, first.select(columns).collect()))
    assert loaded(spark, f"{tmp}/raw") == want and any(k[1] is None for k in want)
    replace_day(again, f"{tmp}/raw", REVIEWS, day)
    kept = Counter({k: n for k, n in want.items() if k[1] != date(2024, 1, 9)})
    assert loaded(spark, f"{tmp}/raw") == kept + Counter(map(tuple, again.select(columns).collect()))


def test_a_load_that_dies_leaves_every_day(spark, tmp, monkeypatch):
    """No day changes before all slices are written."""
    replace_day(reviews(spark, 30, 1), f"{tmp}/raw", REVIEWS, "2024-01-09")
    before, calls = loaded(spark, f"{tmp}/raw"), []

    def dies(s, f=shuffles_dropped):
        calls.append(1)
        if len(calls) == 3:
            raise InterruptedError("died in a slice")
        return f(s)

    monkeypatch.setattr(tables_module, "shuffles_dropped", dies)
    with pytest.raises(InterruptedError):
        replace_day(reviews(spark, 30, 2), f"{tmp}/raw", REVIEWS, "2024-01-09")
    assert loaded(spark, f"{tmp}/raw") == before


def test_lines_of_an_app_lie_together(spark, tmp):
    """each part of the details and catalog feeds goes by app, however the joins were planned."""
    spark.range(4000).selectExpr("id AS l_orderkey", "id * 7919 % 50 AS l_partkey", "1L AS l_suppkey", "1 AS l_linenumber",
                                 "30.0D AS l_quantity", "'N' AS l_returnflag", "'O' AS l_linestatus",
                                 "timestamp_seconds(788918400 + 86400 * (id % 30)) AS l_shipdate").write.parquet(f"{tmp}/lineitem.parquet")
    spark.range(50).selectExpr("id AS p_partkey", "sha2(string(id), 256) AS p_name", "'B' AS p_brand", "'T' AS p_type",
                               "1.0D AS p_retailprice").write.parquet(f"{tmp}/part.parquet")
    spark.range(4000).selectExpr("id AS o_orderkey", "timestamp_seconds(788918400) AS o_orderdate").write.parquet(f"{tmp}/orders.parquet")
    for feed, derived, n in ((APPDETAILS, details_feed, 4000), (CATALOG, catalog_feed, None)):
        path, total = write_feed_day(derived(spark, tmp), f"{tmp}/lake", feed, DAY), 0
        for file in files(path):
            keys = [r.appid for r in load_feed(spark, file, feed).select("appid").collect()]
            assert keys == sorted(keys)
            total += len(keys)
        assert total == (n or derived(spark, tmp).count()) > 0


def test_a_feed_of_many_days_makes_few_files(spark, tmp):
    """A feed of some hundred MB has one bucket, and so one file a day; larger ones still have many."""
    from feedloom.sources import warehouse

    path = f"{tmp}/feed.jsonl"
    for mb, buckets in ((1, 1), (200, 1), (3600, 15)):
        with open(path, "wb") as f:
            f.truncate(mb << 20)  # no blocks on disk
        assert warehouse.buckets_of(spark, path) == buckets
        if mb != 200:
            continue
        warehouse.create_tables(spark, f"{tmp}/wh", "few_files", warehouse.buckets_of(spark, path))
        rows = reviews(spark, 30, 1).unionByName(reviews(spark, 30, 2)).where("ingestion_date IS NOT NULL").repartition(5)
        warehouse.commit_day(rows, "few_files", REVIEWS, "2024-01-09")
        assert len(files(f"{tmp}/wh")) == rows.select("ingestion_date").distinct().count() == 29
        columns = ["appid", "ingestion_date", "total_reviews"]
        assert Counter(map(tuple, spark.table(f"few_files.{REVIEWS}").select(columns).collect())) \
            == Counter(map(tuple, rows.select(columns).collect()))


@pytest.mark.parametrize("buckets", [None, 2])
def test_days_of_the_catalog_are_written_with_zstd(spark, tmp, buckets):
    """Details rows take a fifth of the bytes that they take by default."""
    import pyarrow.parquet as pq

    from feedloom.sources import warehouse

    db = f"zstd_{buckets or 0}"
    warehouse.create_tables(spark, f"{tmp}/wh", db, buckets)
    rows = reviews(spark, 5, 1).where("ingestion_date IS NOT NULL")
    warehouse.commit_day(rows, db, REVIEWS, "2024-01-09")
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files(f"{tmp}/wh")}
    assert codecs == {"ZSTD"}
    assert spark.table(f"{db}.{REVIEWS}").count() == rows.count() == 8
