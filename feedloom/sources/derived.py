"""Feeds derived from the shared parquet tables, for checks and benchmarks.

The recipes map TPC-H-like columns onto the three feeds so that an
independent SQL engine can compute every model answer relationally, while
the Spark side writes real JSONL lines and parses them back.

* details: lineitem ⋈ part (l_partkey) ⋈ orders (l_orderkey), one row per line
* reviews: orders, one row per order
* catalog: distinct (l_partkey, p_name, ship day)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SOURCE_APPDETAILS, SOURCE_CATALOG, SOURCE_REVIEWS

# Fixed recipe values shared with the SQL oracle.
AS_OF = "1998-06-30"
PENDING_RUN_DAY = "1995-06-01"
INGESTED_AT = "1998-06-30T00:00:00+00:00"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null(ddl: str) -> Column:
    return F.lit(None).cast(ddl)


def detail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part with the columns the details recipe uses; the part's wide
    columns come last, so that no shuffle carries them a row a line."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    pt = _table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .join(pt, li.l_partkey == pt.p_partkey))


def _details_raw() -> Column:
    """The app-details object of one line (nested struct, fixed recipe)."""
    ln = F.col("l_linenumber")
    initial = F.round(F.col("p_retailprice") * 100).cast("bigint")
    release_text = (F.when(ln == 2, F.lit("Q1 1999"))
                    .when(ln == 3, F.lit("Coming soon"))
                    .otherwise(F.date_format("o_orderdate", "MMM d, yyyy")))
    genre = "struct<id: string, description: string>"
    genres = F.filter(F.array(
        F.struct(F.lit("1").alias("id"),
                 F.split_part("p_name", F.lit(" "), F.lit(1)).alias("description")),
        F.struct(F.lit("2").alias("id"),
                 F.split_part("p_name", F.lit(" "), F.lit(2)).alias("description")),
        F.when(F.col("p_type") == "ECONOMY",
               F.struct(F.lit("23").alias("id"), F.lit("Indie").alias("description")))
        .otherwise(_null(genre)),
    ), lambda x: x.isNotNull())
    category = "struct<id: bigint, description: string>"
    categories = F.filter(F.array(
        F.when(F.col("l_quantity") >= 25,
               F.struct(F.lit(1).cast("bigint").alias("id"),
                        F.lit("Multi-player").alias("description")))
        .otherwise(_null(category)),
        F.when(F.col("l_quantity").cast("bigint") % 2 == 0,
               F.struct(F.lit(9).cast("bigint").alias("id"),
                        F.lit("Co-op").alias("description")))
        .otherwise(_null(category)),
    ), lambda x: x.isNotNull())
    publishers = (F.when(ln % 2 == 0, F.array("p_brand"))
                  .otherwise(F.array(F.concat(F.lit("Supplier "),
                                              F.col("l_suppkey").cast("string")))))
    return F.struct(
        F.col("l_partkey").alias("steam_appid"),
        F.lit("game").alias("type"),
        F.col("p_name").alias("name"),
        (ln == 1).alias("is_free"),
        F.lit(0).cast("bigint").alias("required_age"),
        F.array("p_brand").alias("developers"),
        publishers.alias("publishers"),
        F.struct(F.lit("USD").alias("currency"), initial.alias("initial"),
                 (initial - ln * 100).alias("final")).alias("price_overview"),
        _null("string").alias("platforms"),
        categories.alias("categories"),
        genres.alias("genres"),
        _null("string").alias("recommendations"),
        F.struct((F.col("l_linestatus") == "O").alias("coming_soon"),
                 release_text.alias("date")).alias("release_date"),
        _null("string").alias("metacritic"),
        _null("string").alias("content_descriptors"),
    )


def details_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App-details feed rows, by app in each part; ``raw`` / ``error_payload`` are nested structs.

    Lines of an app repeat its name and brand, and side by side they gzip to three quarters.
    """
    j = detail_lines(spark, sf_dir).sortWithinPartitions("l_partkey")
    success = F.col("l_returnflag") != F.lit("R")
    return j.select(
        F.lit(INGESTED_AT).alias("ingested_at"),
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
        F.lit(SOURCE_APPDETAILS).alias("source"),
        F.col("l_partkey").alias("appid"),
        success.alias("success"),
        F.when(success, F.lit("game")).alias("type"),
        F.when(success, F.col("p_name")).alias("name"),
        F.when(success, _details_raw()).alias("raw"),
        F.when(~success, F.struct(F.lit(False).alias("success")))
        .alias("error_payload"),
    )


def reviews_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews feed rows (one per order; metrics set on every row)."""
    o = _table(spark, sf_dir, "orders")
    total = F.floor("o_totalprice").cast("bigint") % 40
    good = F.col("o_orderkey") % (total + 1)
    success = F.col("o_orderstatus") != F.lit("F")
    summary = F.struct(
        F.least(total, F.lit(20)).alias("num_reviews"),
        (F.col("o_orderkey") % 10).alias("review_score"),
        F.col("o_orderpriority").alias("review_score_desc"),
        good.alias("total_positive"),
        (total - good).alias("total_negative"),
        total.alias("total_reviews"),
    )
    return o.select(
        F.lit(INGESTED_AT).alias("ingested_at"),
        F.col("o_orderdate").cast("date").alias("ingestion_date"),
        F.lit(SOURCE_REVIEWS).alias("source"),
        F.col("o_custkey").alias("appid"),
        success.alias("success"),
        total.alias("total_reviews"),
        good.alias("good_reviews"),
        (total - good).alias("bad_reviews"),
        (F.col("o_orderkey") % 10).alias("review_score"),
        F.col("o_orderpriority").alias("review_score_desc"),
        F.least(total, F.lit(20)).alias("num_reviews_returned"),
        F.when(success, summary).alias("raw"),
        F.when(~success, F.struct(F.lit(2).alias("success"))).alias("error_payload"),
    )


def catalog_feed(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    """Catalog rows: distinct (part, name, ship day); ``ordered`` by (day, part), else by part in each file.

    The distinct of (part, ship day) and that of (part, name) are taken before their
    join, and the order before the rows get their other columns: names are neither
    hashed a row a line nor sorted with the object that repeats them.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("partition_date")) \
        .filter(F.col("l_partkey").isNotNull()).distinct()
    pt = _table(spark, sf_dir, "part").select("p_partkey", "p_name").distinct()
    rows = (li.join(pt, li.l_partkey == pt.p_partkey)
            .select("l_partkey", "p_name", "partition_date"))
    rows = (rows.orderBy("partition_date", "l_partkey") if ordered
            else rows.sortWithinPartitions("l_partkey", "partition_date"))
    return rows.select(
        F.col("partition_date").cast("string").alias("ingested_at_utc"),
        "partition_date",
        F.lit(SOURCE_CATALOG).alias("source"),
        F.col("l_partkey").alias("appid"),
        F.col("p_name").alias("name"),
        _null("bigint").alias("last_modified"),
        _null("bigint").alias("price_change_number"),
        F.struct(F.col("l_partkey").alias("appid"),
                 F.col("p_name").alias("name")).alias("raw"),
    )


# ---------------------------------------------------------------------------
# Landed payload tables (inputs of the normalisers).  Every payload form a
# fetch can return is derived from key columns, so the oracle can predict
# the shaped row of each.
# ---------------------------------------------------------------------------
FETCH_ERROR_DETAILS = "HTTP 503"
FETCH_ERROR_REVIEWS = "HTTP 429"


def details_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(appid, payload, error): one app-details response per lineitem.

    form by l_orderkey % 50: 1 → ``null``; 2 → ``[]``; 3 → data null;
    4 → data ``[]``; 5 → the key is absent; 6 → success without data;
    7 → the app block is null; otherwise success (not for returnflag R, which
    is refused).  Lines 7 with returnflag A fail to fetch.
    """
    j = detail_lines(spark, sf_dir)
    key = F.col("l_partkey").cast("string")
    k = F.col("l_orderkey") % 50
    raw = _details_raw()
    ok = F.col("l_returnflag") != F.lit("R")

    def wrap(block: Column) -> Column:
        return F.concat(F.lit('{"'), key, F.lit('": '), block, F.lit("}"))

    normal = F.when(ok, wrap(F.concat(F.lit('{"success": true, "data": '), F.to_json(raw),
                                      F.lit("}")))) \
        .otherwise(wrap(F.lit('{"success": false}')))
    payload = (F.when(k == 1, F.lit("null"))
               .when(k == 2, F.lit("[]"))
               .when(k == 3, wrap(F.lit('{"success": true, "data": null}')))
               .when(k == 4, wrap(F.lit('{"success": true, "data": []}')))
               .when(k == 5, F.concat(F.lit('{"'), (F.col("l_partkey") + 1000000)
                                      .cast("string"),
                                      F.lit('": {"success": true, "data": {}}}')))
               .when(k == 6, wrap(F.lit('{"success": true}')))
               .when(k == 7, wrap(F.lit("null")))
               .otherwise(normal))
    fetch_error = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A")
    return j.select(
        F.col("l_partkey").alias("appid"),
        F.when(~fetch_error, payload).alias("payload"),
        F.when(fetch_error, F.lit(FETCH_ERROR_DETAILS)).alias("error"))


def reviews_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(appid, payload, error): one reviews response per order.

    ``success`` is 2 for status F, else by o_orderkey % 7: 3 → true,
    4 → "1" (a string), 5 → 1.0, other → 1.  query_summary is null when
    o_orderkey % 41 = 2, absent when % 43 = 3.  % 37 = 1 → payload ``null``;
    % 31 = 0 → fetch error.
    """
    o = _table(spark, sf_dir, "orders")
    total = F.floor("o_totalprice").cast("bigint") % 40
    good = F.col("o_orderkey") % (total + 1)
    summary = F.struct(
        F.least(total, F.lit(20)).alias("num_reviews"),
        (F.col("o_orderkey") % 10).alias("review_score"),
        F.col("o_orderpriority").alias("review_score_desc"),
        good.alias("total_positive"),
        (total - good).alias("total_negative"),
        total.alias("total_reviews"),
    )
    r7 = F.col("o_orderkey") % 7
    success = (F.when(F.col("o_orderstatus") == "F", F.lit("2"))
               .when(r7 == 3, F.lit("true"))
               .when(r7 == 4, F.lit('"1"'))
               .when(r7 == 5, F.lit("1.0"))
               .otherwise(F.lit("1")))
    qs = (F.when(F.col("o_orderkey") % 41 == 2, F.lit(', "query_summary": null'))
          .when(F.col("o_orderkey") % 43 == 3, F.lit(""))
          .otherwise(F.concat(F.lit(', "query_summary": '), F.to_json(summary))))
    payload = (F.when(F.col("o_orderkey") % 37 == 1, F.lit("null"))
               .otherwise(F.concat(F.lit('{"success": '), success, qs, F.lit("}"))))
    fetch_error = F.col("o_orderkey") % 31 == 0
    return o.select(
        F.col("o_custkey").alias("appid"),
        F.when(~fetch_error, payload).alias("payload"),
        F.when(fetch_error, F.lit(FETCH_ERROR_REVIEWS)).alias("error"))


CATALOG_PAGE_SIZE = 500


def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_no, payload): app-list pages of at most 500 parts each, plus one
    page per region without an ``apps`` list (yields no rows)."""
    p = _table(spark, sf_dir, "part")
    app = F.struct(
        F.col("p_partkey").alias("appid"),
        F.col("p_name").alias("name"),
        (F.col("p_size").cast("bigint") * 1000).alias("last_modified"),
        (F.col("p_partkey") % 13).alias("price_change_number"))
    page_no = (F.col("p_partkey") / CATALOG_PAGE_SIZE).cast("int")
    pages = (p.select(page_no.alias("page_no"), app.alias("app"))
             .groupBy("page_no")
             .agg(F.array_sort(F.collect_list("app")).alias("apps")))
    full = pages.select("page_no", F.to_json(F.struct(F.struct(
        "apps", F.lit(True).alias("have_more_results")).alias("response")))
        .alias("payload"))
    r = _table(spark, sf_dir, "region")
    empty = r.select((F.lit(1000000) + F.col("r_regionkey")).cast("int").alias("page_no"),
                     F.lit('{"response": {"have_more_results": false}}').alias("payload"))
    return full.unionByName(empty)
