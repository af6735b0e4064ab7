"""Command line: the daily steps as Spark jobs.

    python -m feedloom catalog  --pages P --root R --date D
    python -m feedloom pending  --root R --feed steam_appdetails --date D [--limit N]
                                [--raw W] --out P
    python -m feedloom ingest   --payloads P --feed steam_appdetails --root R --date D
    python -m feedloom publish  --src S --lake L --date D
    python -m feedloom load     --lake L --raw W --date D
    python -m feedloom views    --raw W [--db steam_raw]
    python -m feedloom build    --raw W [--db steam] [--select m1,m2] [--as-of D]
                                [--buckets N]

Pages and payloads are landed parquet tables.  Dates default to today's UTC date.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from .plans import incremental, jobs
from .plans.normalize import SHAPERS
from .schemas import FEEDS
from .session import get_session
from .sources import warehouse


def _today() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="feedloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("catalog", help="shape landed app-list pages into the day's catalog")
    p.add_argument("--pages", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--date", default=_today())
    p = sub.add_parser("ingest", help="shape landed payloads into the day's feed")
    p.add_argument("--payloads", required=True)
    p.add_argument("--feed", default="steam_appdetails", choices=sorted(SHAPERS))
    p.add_argument("--batch", default=None, help="name of the batch; a batch is added once")
    p.add_argument("--root", required=True)
    p.add_argument("--date", default=_today())
    p = sub.add_parser("pending", help="write the keys still to fetch")
    p.add_argument("--root", required=True)
    p.add_argument("--feed", default="steam_appdetails")
    p.add_argument("--date", default=_today())
    p.add_argument("--limit", type=int, default=None)
    p.add_argument("--raw", default=None, help="loaded raw tables to take the history from")
    p.add_argument("--state", default=None, help="kept table of done keys to take the history from")
    p.add_argument("--out", required=True)
    p = sub.add_parser("publish", help="copy a day's feeds to the lake")
    p.add_argument("--src", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--date", default=_today())
    p = sub.add_parser("load", help="replace a day in the raw tables")
    p.add_argument("--lake", required=True)
    p.add_argument("--raw", required=True)
    p.add_argument("--date", default=_today())
    p.add_argument("--db", default=None, help="load into tables of the catalog, views included")
    p.add_argument("--buckets", type=int, default=None)
    p = sub.add_parser("clean", help="remove folders of replaced days from the raw tables")
    p.add_argument("--db", required=True)
    p = sub.add_parser("views", help="raw tables and staging views in the catalog")
    p.add_argument("--raw", required=True)
    p.add_argument("--db", default="steam_raw")
    p = sub.add_parser("build", help="build staging views and mart tables")
    p.add_argument("--raw", default=None)
    p.add_argument("--raw-db", default=None, help="raw tables of the catalog in place of folders")
    p.add_argument("--db", default="steam")
    p.add_argument("--select", default=None)
    p.add_argument("--as-of", default=None)
    p.add_argument("--location", default=None)
    p.add_argument("--buckets", type=int, default=None)
    a = ap.parse_args(argv)

    spark = get_session()
    if a.cmd == "catalog":
        jobs.ingest_catalog(spark, spark.read.parquet(a.pages), a.root, a.date)
    elif a.cmd == "ingest":
        jobs.ingest(spark, spark.read.parquet(a.payloads), a.feed, a.root, a.date, batch=a.batch)
    elif a.cmd == "pending":
        keys = incremental.pending(spark, a.root, a.feed, a.date, a.limit, a.raw, a.state)
        keys.select("appid", "pos.file", "pos.block", "pos.row") \
            .write.mode("overwrite").parquet(a.out)
    elif a.cmd == "publish":
        jobs.publish_day(spark, a.src, a.lake, a.date)
    elif a.cmd == "load":
        if a.db:
            jobs.load_tables(spark, a.lake, a.date, a.raw, a.db, buckets=a.buckets)
        else:
            jobs.load_day(spark, a.lake, a.date, a.raw)
    elif a.cmd == "clean":
        for feed in FEEDS:
            warehouse.remove_stale(spark, a.db, feed)
    elif a.cmd == "views":
        jobs.publish_views(spark, a.raw, a.db)
    elif a.cmd == "build":
        select = a.select.split(",") if a.select else None
        if (a.raw is None) == (a.raw_db is None):
            ap.error("build needs one of --raw and --raw-db")
        jobs.build_all(spark, a.raw, a.db, select, a.as_of, a.location, a.buckets, a.raw_db)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
