"""Raw tables of the catalog: days committed by location, live views, bucketed reads; byte
copies; batches; the model graph."""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feedloom.operators.latest import latest_per_key
from feedloom.plans import graph, incremental, jobs, staging
from feedloom.schemas import FEEDS
from feedloom.sources import warehouse
from feedloom.sources.copies import copy_tree
from feedloom.sources.feeds import feed_path, load_feed, payload_batch, read_catalog, read_failed

from .helpers import details_raw, details_row, reviews_row, write_lines

DAY, NEXT = "2024-01-02", "2024-01-03"


def _land(root: str, day: str, keys=(1, 2), name="A") -> None:
    write_lines(feed_path(root, "steam_catalog", day),
                [{"partition_date": day, "appid": k, "name": f"{name}{k}"} for k in keys])
    write_lines(feed_path(root, "steam_appdetails", day), [
        details_row(k, day, raw=details_raw(genres=[{"id": "23", "description": "Indie"}],
                                            categories=[{"id": k, "description": "Co-op"}])) for k in keys])
    write_lines(feed_path(root, "steam_reviews", day), [reviews_row(k, day) for k in keys])


@pytest.fixture()
def db():
    return f"wh_{uuid.uuid4().hex[:8]}"


def _rows(spark, table):
    return Counter((r.appid, str(r.ingestion_date), r.total_reviews) for r in spark.table(table).collect())


# --- K7: views ------------------------------------------------------------

@pytest.mark.parametrize("buckets", [None, 3])
def test_views_are_current_in_another_session(spark, tmp, db, buckets):
    lake, wh = os.path.join(tmp, "lake"), os.path.join(tmp, "wh")
    other = spark.newSession()
    _land(lake, DAY)
    _land(lake, NEXT, keys=(2, 3), name="B")
    jobs.load_tables(spark, lake, DAY, wh, db, buckets=buckets)
    views = ("stg_steam_catalog", "stg_steam_appdetails", "stg_steam_reviews")
    assert [other.table(f"{db}.{v}").count() for v in views] == [2, 2, 2]
    for feed in FEEDS:  # no view is touched by these loads
        warehouse.commit_day(load_feed(spark, feed_path(lake, feed, NEXT), feed), db, feed, NEXT)
    assert [other.table(f"{db}.{v}").count() for v in views] == [3, 3, 3]
    assert {(r.appid, r.name) for r in other.table(f"{db}.stg_steam_catalog").collect()} == \
        {(1, "A1"), (2, "B2"), (3, "B3")}


def test_view_text_extracts_what_the_staging_model_does(spark, tmp, db):
    lake = os.path.join(tmp, "lake")
    odd = [details_raw(), details_raw(genres=[{"id": "7"}, {"id": None, "description": {"a": 1}}]),
           {"release_date": {"date": {"y": 1}}, "is_free": "true", "categories": None, "developers": []},
           {}, None, details_raw(publishers=None, categories=[{"id": 1, "description": "[x"}])]
    rows = [details_row(k, DAY, raw=r) for k, r in enumerate(odd)]
    rows += [details_row(0, NEXT, success=False), details_row(1, "2023-01-01", raw=details_raw(is_free=True)),
             details_row(None, DAY, raw=details_raw()), rows[0]]
    write_lines(feed_path(lake, "steam_appdetails", DAY), rows)
    jobs.load_tables(spark, lake, DAY, os.path.join(tmp, "wh"), db, feeds=("steam_appdetails",), buckets=2)
    want = staging.stg_appdetails(warehouse.raw_table(spark, db, "steam_appdetails"))
    got = spark.newSession().table(f"{db}.stg_steam_appdetails")
    assert got.schema == want.schema or [f.name for f in got.schema] == [f.name for f in want.schema]
    assert Counter(map(str, got.collect())) == Counter(map(str, want.collect())) and want.count() == 6


# --- K5: commits ----------------------------------------------------------

def test_a_load_that_dies_leaves_the_old_day_or_the_new_one(spark, tmp, db):
    """Stopped after each step, and run again to its end."""
    warehouse.create_tables(spark, tmp, db, buckets=2)
    table = f"{db}.steam_reviews"

    def feed(total, *days):
        return spark.createDataFrame([(k, d, total) for d in days for k in (1, 2)], "appid long, d string, total_reviews long") \
            .withColumn("ingestion_date", F.col("d").cast("date"))

    def rows(total, *days):
        return Counter({(k, d, total): 1 for d in days for k in (1, 2)})

    days = (DAY, "2023-12-30", "2023-12-31")  # its own, one that is there, a new one
    warehouse.commit_day(feed(0, DAY, "2023-12-30"), db, "steam_reviews", DAY)
    before = rows(0, DAY)
    steps = len(list(warehouse.day_load(feed(0, *days[:2]), db, "steam_reviews", DAY)))
    assert steps == 3  # written, added, committed: both days are there
    for stop in range(1, 6):
        total = stop * 10
        load = warehouse.day_load(feed(total, DAY, "2023-12-30", f"2022-01-0{stop}"), db, "steam_reviews", DAY)
        done = ""
        for _ in range(stop):
            done, _ = next(load, ("over", ""))
        load.close()
        seen = {k: n for k, n in _rows(spark.newSession(), table).items() if k[1] == DAY}
        assert seen in (dict(before), dict(rows(total, DAY))), done
        assert (seen == dict(rows(total, DAY))) == (done in ("committed", "over"))
        warehouse.commit_day(feed(total + 1, DAY), db, "steam_reviews", DAY)
        before = rows(total + 1, DAY)
        assert {k: n for k, n in _rows(spark, table).items() if k[1] == DAY} == dict(before)


def test_a_bad_record_changes_no_day(spark, tmp, db):
    lake, wh = os.path.join(tmp, "lake"), os.path.join(tmp, "wh")
    _land(lake, DAY)
    jobs.load_tables(spark, lake, DAY, wh, db, buckets=2)
    write_lines(feed_path(lake, "steam_reviews", DAY),
                [reviews_row(9, DAY), reviews_row(8, "2023-01-01"), '{"ingestion_date": "2024-01-02", "appid": "x"}'])
    old = _rows(spark, f"{db}.steam_reviews")
    with pytest.raises(Exception):
        jobs.load_tables(spark, lake, DAY, wh, db, feeds=("steam_reviews",))
    assert _rows(spark, f"{db}.steam_reviews") == old
    assert not spark.sql(f"SHOW TABLES IN {db} LIKE 'load_*'").count()


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_day_is_replaced_emptied_and_cleaned(spark, tmp, db, buckets):
    warehouse.create_tables(spark, tmp, db, buckets)
    df = spark.createDataFrame([(1, DAY, 5), (1, DAY, 5), (None, DAY, 6), (2, None, 7), (3, NEXT, 8)],
                               "appid long, d string, total_reviews long").withColumn("ingestion_date", F.col("d").cast("date"))
    for _ in range(2):
        warehouse.commit_day(df, db, "steam_reviews", DAY)
    got = _rows(spark, f"{db}.steam_reviews")
    assert got == Counter({(1, DAY, 5): 2, (None, DAY, 6): 1, (2, "None", 7): 2, (3, NEXT, 8): 2})
    assert warehouse.known_days(spark, f"{db}.steam_reviews") == {DAY, NEXT, warehouse.NULL_DAY}
    warehouse.commit_day(df.limit(0), db, "steam_reviews", "2024-1-2")
    assert {k[1] for k in _rows(spark, f"{db}.steam_reviews")} == {"None", NEXT}
    before = _rows(spark, f"{db}.steam_reviews")
    warehouse.remove_stale(spark, db, "steam_reviews")
    assert _rows(spark.newSession(), f"{db}.steam_reviews") == before
    loads = os.listdir(os.path.join(tmp, "steam_reviews", warehouse.LOADS))
    assert len(loads) == 2  # of the first load the other days, of the last the empty day
    with pytest.raises(AnalysisException):
        warehouse.commit_day(df, db + "x", "steam_reviews", DAY)


# --- K4: clustered reads --------------------------------------------------

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_are_read_in_place(spark, tmp, db):
    rows = [{"partition_date": d, "appid": k % 40, "name": f"n{k % 7}"} for d in (DAY, NEXT) for k in range(90)]
    lake = os.path.join(tmp, "lake")
    write_lines(feed_path(lake, "steam_catalog", DAY), rows)
    _land(lake, NEXT, keys=range(50))
    jobs.load_tables(spark, lake, DAY, os.path.join(tmp, "wh"), db, feeds=("steam_catalog",), buckets=4)
    jobs.load_tables(spark, lake, NEXT, os.path.join(tmp, "wh"), db, feeds=("steam_reviews",))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = warehouse.raw_table(spark, db, "steam_catalog")
        model = staging.stg_catalog(table, "bucketed")
        assert "Exchange" not in _plan(model) and "SortMergeJoin" in _plan(model)
        assert "Exchange" in _plan(staging.stg_catalog(table))
        for view in ("stg_steam_catalog", "stg_steam_reviews"):
            assert "Exchange" not in _plan(spark.table(f"{db}.{view}"))
        assert Counter(map(tuple, model.collect())) == Counter(map(tuple, staging.stg_catalog(table).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_three_forms_of_latest_agree(spark):
    df = spark.createDataFrame([(k % 5 if k % 7 else None, f"2024-01-{k % 9 + 1:02d}" if k % 4 else None, k)
                                for k in range(60)], "appid int, d string, v int") \
        .withColumn("ingestion_date", F.col("d").cast("date"))
    got = [Counter(map(tuple, latest_per_key(df, method=m).collect())) for m in ("join", "rank", "bucketed")]
    assert got[0] == got[1] == got[2] and got[0]


# --- K6: copies -----------------------------------------------------------

def test_a_published_day_is_the_same_bytes(spark, tmp):
    src, lake = os.path.join(tmp, "src"), os.path.join(tmp, "lake")
    _land(src, DAY)
    path = feed_path(src, "steam_catalog", DAY)
    os.remove(path)
    os.makedirs(os.path.join(path, "batch-b"))
    bodies = {f"part-{k:05d}": b"".join(b'{"appid": %d, "name": "\xc3\xa9"}\r\n' % (1000 * k + j) for j in range(n))
              for k, n in enumerate((3, 400, 20))}
    bodies |= {"part-00009": b'{"appid": 7}', "part-00010": b"", "batch-b/part-0": b'{"appid": 8}\n\n'}
    for name, body in bodies.items():
        with open(os.path.join(path, name), "wb") as f:
            f.write(body)
    write_lines(os.path.join(path, "_SUCCESS"), [])
    keys = [r.appid for r in read_catalog(spark, src, DAY).collect()]
    for _ in range(2):  # a copy is replaced by the next
        jobs.publish_day(spark, src, lake, DAY)
        out = feed_path(lake, "steam_catalog", DAY)
        found = {os.path.relpath(os.path.join(d, f), out): open(os.path.join(d, f), "rb").read()
                 for d, _, names in os.walk(out) for f in names if not f.startswith(".")}
        assert found == bodies
        assert [r.appid for r in read_catalog(spark, lake, DAY).collect()] == keys
    manifest = {r["name"]: r for r in spark.read.json(jobs.manifest_path(lake, "steam_catalog", DAY)).collect()}
    assert {n: (r["size"], r["sha256"]) for n, r in manifest.items()} == \
        {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items()}
    assert open(feed_path(lake, "steam_reviews", DAY), "rb").read() == open(feed_path(src, "steam_reviews", DAY), "rb").read()
    assert not [f for f in os.listdir(os.path.join(lake, "steam_catalog")) if f.startswith("_copy")]


def test_a_copier_needs_no_package_in_the_workers(tmp):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from feedloom.sources.copies import file_copier

    src, dst, code = (os.path.join(tmp, n) for n in ("a", "b", "f.pkl"))
    write_lines(src, ["one"])
    with open(code, "wb") as f:
        f.write(cloudpickle.dumps(file_copier()))
    run = f"import pickle; print(pickle.load(open({code!r}, 'rb'))({'file://' + src!r}, {'file://' + dst!r})[0])"
    out = subprocess.run([sys.executable, "-c", run], cwd=tmp, capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.stdout.strip() == "4" and open(dst).read() == "one\n", out.stderr


def test_a_copy_that_fails_leaves_the_one_of_before(spark, tmp, monkeypatch):
    a, b = os.path.join(tmp, "a.txt"), os.path.join(tmp, "lake", "a.txt")
    write_lines(a, ["one"])
    copy_tree(spark, a, b)
    write_lines(a, ["two", "three"])
    from feedloom.sources import copies
    real = copies._files
    monkeypatch.setattr(copies, "_files", lambda fs, p: {k: (u, n + 1) for k, (u, n) in real(fs, p).items()})
    with pytest.raises(OSError):
        copy_tree(spark, a, b)
    assert open(b).read() == "one\n"
    with pytest.raises(Exception):
        copy_tree(spark, os.path.join(tmp, "none"), b)


# --- K2, M10: batches -----------------------------------------------------

def _payloads(spark, path, keys):
    spark.createDataFrame(
        [(k, f'{{"{k}": {{"success": true, "data": {{"name": "n{k}", "type": "game"}}}}}}', None) for k in keys]
        + [(100 + k, None, "timeout") for k in keys], "appid bigint, payload string, error string") \
        .repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("dies_in", ["write_feed_batch", "write_failed", "after feed rename"])
def test_an_ingest_that_died_leaves_each_row_once(spark, tmp, monkeypatch, dies_in):
    payloads, root = _payloads(spark, os.path.join(tmp, "landed"), (1, 2)), os.path.join(tmp, "lake")

    def die(*_, **__):
        raise InterruptedError

    with monkeypatch.context() as m:
        if dies_in == "after feed rename":
            real = jobs.write_feed_batch
            m.setattr(jobs, "write_feed_batch", lambda *a: (real(*a), die()))
        else:
            m.setattr(jobs, dies_in, die)
        with pytest.raises(InterruptedError):
            jobs.ingest(spark, payloads, "steam_appdetails", root, DAY)
    for _ in range(2):
        jobs.ingest(spark, payloads, "steam_appdetails", root, DAY)
    feed = load_feed(spark, feed_path(root, "steam_appdetails", DAY), "steam_appdetails")
    assert sorted(r.appid for r in feed.collect()) == [1, 2, 101, 102]
    assert sorted(r.appid for r in read_failed(spark, root, "steam_appdetails", DAY).collect()) == [101, 102]
    more = _payloads(spark, os.path.join(tmp, "landed2"), (3,))
    assert payload_batch(more) != payload_batch(payloads) == payload_batch(spark.read.parquet(os.path.join(tmp, "landed")))
    jobs.ingest(spark, more, "steam_appdetails", root, DAY)
    assert feed.sparkSession.read.json(feed_path(root, "steam_appdetails", DAY), recursiveFileLookup=True).count() == 6


def test_an_attempt_is_not_read(spark, tmp):
    path = feed_path(tmp, "steam_catalog", DAY)
    write_lines(os.path.join(path, "part-0"), [{"appid": 1}])
    write_lines(os.path.join(path, "_attempt-x", "part-0"), [{"appid": 2}])
    write_lines(os.path.join(path, "batch-y", "part-0"), [{"appid": 3}])
    assert sorted(r.appid for r in read_catalog(spark, tmp, DAY).collect()) == [1, 3]
    with pytest.raises(ValueError):
        jobs.ingest(spark, spark.createDataFrame([], "appid long, payload string, error string"),
                    "steam_reviews", tmp, DAY, batch="../x")


# --- A4, M9: kept keys ----------------------------------------------------

def test_done_keys_are_kept_by_day(spark, tmp):
    lake, state = os.path.join(tmp, "lake"), os.path.join(tmp, "state")
    feed = "steam_appdetails"

    def land(day, *rows):
        write_lines(feed_path(lake, feed, day), [details_row(k, day, success=s) for k, s in rows])

    write_lines(feed_path(lake, "steam_catalog", NEXT), [{"appid": k} for k in range(1, 9)])

    def todo(**kw):
        return sorted(r.appid for r in incremental.pending(spark, lake, feed, NEXT, **kw).collect())

    assert todo(state_root=state) == todo() == list(range(1, 9))  # no history at all
    land("2024-01-01", (1, True), (2, False))
    land(NEXT, (3, True))
    assert incremental.keep_done_keys(spark, lake, feed, NEXT, state) == ["2024-01-01"]
    assert todo(state_root=state) == todo() == [2, 4, 5, 6, 7, 8]
    assert incremental.keep_done_keys(spark, lake, feed, NEXT, state) == []
    land("2024-01-01", (2, True))  # the day's file was replaced
    land(DAY, (5, True), (5, True))
    assert incremental.keep_done_keys(spark, lake, feed, NEXT, state) == ["2024-01-01", DAY]
    assert todo(state_root=state) == todo() == [1, 4, 6, 7, 8]
    land(NEXT, (3, True), (4, True))  # today's file is read as it is
    assert todo(state_root=state) == todo() == [1, 6, 7, 8]
    with pytest.raises(ValueError):
        todo(state_root=state, raw_root=tmp)


# --- M12: the graph -------------------------------------------------------

def test_the_graph_selects_what_a_model_reads():
    assert graph.closure(None) == set(graph.MODELS)
    assert graph.closure(["mart_steam_details_reviews"]) == {
        "mart_steam_details_reviews", "mart_steam_appdetails", "mart_steam_reviews",
        "stg_steam_appdetails", "stg_steam_reviews"}
    assert graph.sources(graph.closure(["mart_steam_reviews"])) == {"steam_reviews"}
    with pytest.raises(ValueError, match="mart_typo"):
        graph.closure(["mart_typo", "mart_steam_genres"])


def test_models_are_built_after_what_they_read_and_side_by_side():
    def model(*inputs):
        return graph.Model(inputs, True, None)

    models = {"a": model("raw"), "b": model("raw"), "c": model("a", "b"), "d": model("c"), "e": model("raw")}
    both = threading.Barrier(2, timeout=20)

    def build(name):
        if name in ("a", "b"):
            both.wait()  # passes only if the two run at once

    done = graph.build_in_order({"a", "b", "c", "d"}, build, models)
    assert done.index("c") > max(done.index("a"), done.index("b")) and done[-1] == "d"
    seen = []

    def fail(name):
        seen.append(name)
        if name == "b":
            raise RuntimeError("b")

    with pytest.raises(RuntimeError):
        graph.build_in_order({"a", "b", "c", "d"}, fail, models)
    assert "c" not in seen and "d" not in seen


def test_one_mart_needs_only_its_own_source(spark, tmp, db):
    lake, wh = os.path.join(tmp, "lake"), os.path.join(tmp, "wh")
    _land(lake, DAY)
    jobs.load_day(spark, lake, DAY, wh, feeds=("steam_reviews",))
    os.rmdir(os.path.join(wh, "steam_catalog"))
    built = jobs.build_all(spark, wh, out_db=db, location=os.path.join(tmp, "m"), select=["mart_steam_reviews"])
    assert list(built) == ["stg_steam_reviews", "mart_steam_reviews"] and built["mart_steam_reviews"].count() == 2
    with pytest.raises(ValueError):
        jobs.build_all(spark, wh, out_db=db, select=["mart_typo"])


def test_cli_loads_and_builds_catalog_tables(spark, tmp, db):
    from feedloom.__main__ import main

    lake, wh = os.path.join(tmp, "lake"), os.path.join(tmp, "wh")
    _land(lake, DAY)
    assert main(["load", "--lake", lake, "--raw", wh, "--date", DAY, "--db", db, "--buckets", "2"]) == 0
    assert main(["build", "--raw-db", db, "--db", db + "_m", "--as-of", "2024-06-30",
                 "--select", "mart_steam_details_reviews", "--location", os.path.join(tmp, "marts")]) == 0
    assert spark.table(f"{db}_m.mart_steam_details_reviews").count() == 2
    assert main(["clean", "--db", db]) == 0 and spark.table(f"{db}.steam_reviews").count() == 2
    with pytest.raises(SystemExit):
        main(["build", "--db", db + "_m"])


def test_listing_takes_four_tasks_a_core_and_keeps_a_set_number(spark):
    from feedloom.session import LISTING, size_listing

    before = spark.conf.get(LISTING)
    try:
        spark.conf.unset(LISTING)
        size_listing(spark)
        assert int(spark.conf.get(LISTING)) == 4 * spark.sparkContext.defaultParallelism
        spark.conf.set(LISTING, "7")
        size_listing(spark)
        assert spark.conf.get(LISTING) == "7"
    finally:
        spark.conf.set(LISTING, before)
