"""Independent SQL (DuckDB dialect) for every checked query.

The SQL works on the parquet columns directly, with no JSON: it applies the
same feed recipe and the model semantics relationally.
"""

from __future__ import annotations

from ..schemas import TRIMMED_DETAIL_KEYS
from ..sources.derived import AS_OF, INGESTED_AT, PENDING_RUN_DAY
from .fixtures import REPLACED_DAY
from .registry import PENDING_LIMIT

# Details feed rows (one per lineitem), in columns.
_DETAILS = """
details AS (
  SELECT l_partkey AS appid,
         CAST(l_shipdate AS DATE) AS ingestion_date,
         l_returnflag <> 'R' AS success,
         CASE WHEN l_returnflag <> 'R' THEN p_name END AS name,
         l_linenumber, l_quantity, l_linestatus, l_suppkey,
         p_name, p_brand, p_type, p_retailprice, o_orderdate
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN orders ON o_orderkey = l_orderkey
),
latest_ok AS (
  SELECT d.* FROM details d
  JOIN (SELECT appid, max(ingestion_date) AS mx FROM details WHERE success
        GROUP BY appid) m
    ON d.appid = m.appid AND d.ingestion_date = m.mx
  WHERE d.success
),
stg AS (
  SELECT DISTINCT
    appid, name,
    l_linenumber = 1 AS is_free,
    l_linestatus = 'O' AS is_coming_soon,
    CASE l_linenumber WHEN 2 THEN 'Q1 1999' WHEN 3 THEN 'Coming soon'
         ELSE strftime(o_orderdate, '%b %-d, %Y') END AS release_date,
    p_brand AS developers,
    CASE WHEN l_linenumber % 2 = 0 THEN p_brand
         ELSE 'Supplier ' || CAST(l_suppkey AS VARCHAR) END AS publishers,
    'USD' AS currency,
    CAST(round(p_retailprice * 100) AS BIGINT) / 100 AS original_price,
    (CAST(round(p_retailprice * 100) AS BIGINT) - 100 * l_linenumber) / 100
      AS discount_price,
    l_quantity >= 25 AS has_mp,
    CAST(l_quantity AS BIGINT) % 2 = 0 AS has_coop,
    split_part(p_name, ' ', 1) AS g1,
    split_part(p_name, ' ', 2) AS g2,
    p_type = 'ECONOMY' AS g23
  FROM latest_ok
),
mart_base AS (
  SELECT *, try_strptime(release_date, '%b %-d, %Y')::DATE AS cleaned_release_date
  FROM stg
),
mart_ad AS (
  SELECT appid, name, is_free, is_coming_soon, cleaned_release_date,
         developers, publishers,
         has_mp AS is_multiplayer,
         has_coop AS is_coop,
         (g23 OR g1 = 'Indie' OR g2 = 'Indie') AS is_indie,
         developers = publishers AS is_self_published,
         ((g23 OR g1 = 'Indie' OR g2 = 'Indie') AND developers = publishers)
           AS is_very_indie
  FROM mart_base
  WHERE cleaned_release_date IS NOT NULL
    AND cleaned_release_date <= DATE '""" + AS_OF + """'
)"""

# Reviews feed rows (one per order), in columns.
_REVIEWS = """
reviews AS (
  SELECT o_custkey AS appid,
         CAST(o_orderdate AS DATE) AS ingestion_date,
         o_orderstatus <> 'F' AS success,
         CAST(floor(o_totalprice) AS BIGINT) % 40 AS total_reviews,
         o_orderkey % (CAST(floor(o_totalprice) AS BIGINT) % 40 + 1) AS good_reviews,
         CAST(floor(o_totalprice) AS BIGINT) % 40
           - o_orderkey % (CAST(floor(o_totalprice) AS BIGINT) % 40 + 1) AS bad_reviews,
         o_orderkey % 10 AS review_score,
         o_orderpriority AS review_score_desc
  FROM orders
),
stg_rv AS (
  SELECT DISTINCT r.appid, r.total_reviews, r.good_reviews, r.bad_reviews,
         r.review_score, r.review_score_desc
  FROM reviews r
  JOIN (SELECT appid, max(ingestion_date) AS mx FROM reviews GROUP BY appid) m
    ON r.appid = m.appid AND r.ingestion_date = m.mx
),
mart_rv AS (
  SELECT *, good_reviews / NULLIF(total_reviews, 0) AS good_review_ratio FROM stg_rv
)"""

_CATALOG = """
catalog AS (
  SELECT DISTINCT l_partkey AS appid, p_name AS name,
         CAST(l_shipdate AS DATE) AS partition_date
  FROM lineitem JOIN part ON p_partkey = l_partkey
)"""

_RUN = f"DATE '{PENDING_RUN_DAY}'"
_REPLACED = f"DATE '{REPLACED_DAY}'"

# Reviews dated to the first day of their year.



def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_EXPLODED_COLS = ("is_free, is_coming_soon, cleaned_release_date, original_price, "
                  "discount_price")
_RELEASED = ("cleaned_release_date IS NOT NULL AND cleaned_release_date <= DATE '"
             + AS_OF + "'")

ORACLE_SQL: dict[str, str] = {
    "latest_per_key": _with(_DETAILS) + """
SELECT appid, ingestion_date, name FROM latest_ok""",
    "stg_catalog": _with(_CATALOG) + """
SELECT DISTINCT c.appid, c.name FROM catalog c
JOIN (SELECT appid, max(partition_date) AS mx FROM catalog GROUP BY appid) m
  ON c.appid = m.appid AND c.partition_date = m.mx""",
    "stg_appdetails": _with(_DETAILS) + """
SELECT appid, name, is_free, is_coming_soon, release_date, developers, publishers,
       currency, original_price, discount_price,
       concat_ws('|', CASE WHEN has_mp THEN '1:Multi-player' END,
                      CASE WHEN has_coop THEN '9:Co-op' END) AS categories,
       concat_ws('|', '1:' || g1, '2:' || g2, CASE WHEN g23 THEN '23:Indie' END) AS genres
FROM stg""",
    "stg_reviews": _with(_REVIEWS) + """
SELECT * FROM stg_rv""",
    "mart_appdetails": _with(_DETAILS) + """
SELECT * FROM mart_ad""",
    "mart_categories": _with(_DETAILS) + f"""
SELECT appid, 'Multi-player' AS category_name, {_EXPLODED_COLS}
FROM mart_base WHERE has_mp AND {_RELEASED}
UNION ALL
SELECT appid, 'Co-op' AS category_name, {_EXPLODED_COLS}
FROM mart_base WHERE has_coop AND {_RELEASED}""",
    "mart_genres": _with(_DETAILS) + f"""
SELECT appid, g1 AS genre_name, {_EXPLODED_COLS} FROM mart_base WHERE {_RELEASED}
UNION ALL
SELECT appid, g2 AS genre_name, {_EXPLODED_COLS} FROM mart_base WHERE {_RELEASED}
UNION ALL
SELECT appid, 'Indie' AS genre_name, {_EXPLODED_COLS}
FROM mart_base WHERE g23 AND {_RELEASED}""",
    "mart_reviews": _with(_REVIEWS) + """
SELECT * FROM mart_rv""",
    "mart_details_reviews": _with(_DETAILS, _REVIEWS) + """
SELECT ad.appid, ad.name, ad.is_free, ad.is_coming_soon, ad.is_coop, ad.is_indie,
       ad.is_self_published, ad.is_multiplayer, ad.cleaned_release_date,
       ad.developers, ad.publishers,
       r.total_reviews, r.good_reviews, r.good_review_ratio
FROM mart_ad ad LEFT JOIN mart_rv r ON ad.appid = r.appid""",
    "pending_details": _with(_DETAILS, _CATALOG) + f"""
SELECT appid FROM catalog
EXCEPT
SELECT appid FROM details WHERE success AND ingestion_date <= {_RUN}""",
    "pending_reviews": _with(_REVIEWS, _CATALOG) + f"""
SELECT appid FROM catalog
EXCEPT
SELECT appid FROM reviews WHERE success AND ingestion_date <= {_RUN}""",
    "limit_pending": _with(_DETAILS, _CATALOG) + f"""
SELECT appid FROM (
  SELECT appid, min(partition_date) AS first_day FROM catalog GROUP BY appid
) c
WHERE appid NOT IN (SELECT appid FROM details WHERE success AND ingestion_date <= {_RUN})
ORDER BY first_day, appid
LIMIT {PENDING_LIMIT}""",
    "run_counts": _with(_DETAILS, _CATALOG) + f"""
SELECT
  (SELECT count(DISTINCT appid) FROM catalog) AS catalog_keys,
  (SELECT count(DISTINCT appid) FROM details
    WHERE success AND ingestion_date < {_RUN}) AS historic_processed,
  (SELECT count(DISTINCT appid) FROM details
    WHERE success AND ingestion_date = {_RUN}) AS today_processed,
  (SELECT count(*) FROM (SELECT appid FROM catalog EXCEPT
     SELECT appid FROM details WHERE success AND ingestion_date <= {_RUN})) AS pending_keys""",
    "union_processed": _with(_DETAILS) + f"""
SELECT DISTINCT appid FROM details WHERE success AND ingestion_date <= {_RUN}""",
    "processed_today": _with(_REVIEWS) + f"""
SELECT DISTINCT appid FROM reviews WHERE success AND ingestion_date = {_RUN}""",
    "catalog_fallback": _with(_CATALOG) + f"""
SELECT appid, name, partition_date, {_RUN} AS file_day FROM catalog""",
    "replace_day_twice": _with(_REVIEWS) + f"""
SELECT appid, ingestion_date, success, review_score_desc,
       total_reviews + CASE WHEN ingestion_date = {_REPLACED} THEN 1 ELSE 0 END AS total_reviews
FROM reviews""",
    "replace_day_emptied": _with(_REVIEWS) + f"""
SELECT appid, ingestion_date, success, review_score_desc, total_reviews
FROM reviews WHERE ingestion_date <> {_REPLACED}""",
    "raw_on_day": _with(_REVIEWS) + f"""
SELECT appid, total_reviews + 1 AS total_reviews, success
FROM reviews WHERE ingestion_date = {_REPLACED}""",
}
ORACLE_SQL["run_counts_limited"] = f"""
SELECT * REPLACE (least(pending_keys, {PENDING_LIMIT}) AS pending_keys)
FROM ({ORACLE_SQL["run_counts"]})"""
ORACLE_SQL["pending_details_kept"] = ORACLE_SQL["pending_details_loaded"] = ORACLE_SQL["pending_details"]
ORACLE_SQL["latest_per_key_rank"] = ORACLE_SQL["latest_per_key"]

# -- normalisers: payload forms predicted from key columns --------------------
_DETAIL_PAYLOADS = """
p AS (
  SELECT l_partkey AS appid, l_orderkey % 50 AS k,
         l_linenumber = 7 AND l_returnflag = 'A' AS fetch_err,
         l_returnflag <> 'R' AS ok_flag, l_linenumber, p_name, p_type, p_retailprice,
         p_brand, l_suppkey, l_quantity, l_linestatus, o_orderdate,
         CAST(round(p_retailprice * 100) AS BIGINT) AS cents
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN orders ON o_orderkey = l_orderkey
),
c AS (
  SELECT *,
    CASE WHEN fetch_err THEN 'HTTP 503'
         WHEN k IN (1, 2) THEN 'payload is not a JSON object'
         WHEN k = 7 THEN 'app block is not a JSON object'
         WHEN k IN (3, 4) THEN 'data is not a JSON object' END AS error,
    NOT fetch_err AND (k = 6 OR (k NOT IN (1, 2, 3, 4, 5, 6, 7) AND ok_flag)) AS success,
    NOT fetch_err AND k NOT IN (1, 2, 3, 4, 5, 6, 7) AND ok_flag AS with_data
  FROM p
)"""

_REVIEW_PAYLOADS = """
o AS (
  SELECT o_custkey AS appid, o_orderkey, o_orderpriority,
         CAST(floor(o_totalprice) AS BIGINT) % 40 AS total,
         o_orderkey % 31 = 0 AS fetch_err,
         o_orderkey % 37 = 1 AS null_payload,
         o_orderstatus <> 'F' AND o_orderkey % 7 <> 4 AS ok0,
         o_orderkey % 41 = 2 AS qs_null,
         o_orderkey % 43 = 3 AS qs_absent
  FROM orders
),
c AS (
  SELECT *,
    CASE WHEN fetch_err THEN 'HTTP 429'
         WHEN null_payload THEN 'payload is not a JSON object'
         WHEN ok0 AND qs_null THEN 'query_summary is not a JSON object' END AS error
  FROM o
),
d AS (
  SELECT *, error IS NULL AND ok0 AS success,
         error IS NULL AND ok0 AND NOT qs_null AND NOT qs_absent AS with_qs
  FROM c
)"""

ORACLE_SQL.update({
    "ingest_details": _with(_DETAIL_PAYLOADS) + f"""
SELECT appid, DATE '{AS_OF}' AS ingestion_date, success,
  CASE WHEN with_data THEN 'game' END AS type,
  CASE WHEN with_data THEN p_name END AS name,
  CASE WHEN with_data THEN CAST(l_linenumber = 1 AS VARCHAR) END AS is_free,
  CASE WHEN with_data THEN CAST(CAST(round(p_retailprice * 100) AS BIGINT)
                                - 100 * l_linenumber AS VARCHAR) END AS price_final,
  CASE WHEN with_data AND p_type = 'ECONOMY' THEN 'Indie' END AS genre3,
  error,
  CASE WHEN error IS NULL AND NOT success AND k <> 5 THEN 'false' END AS refused
FROM c""",
    # whole envelopes: kept keys in their order, those of nested objects by name
    "ingest_resumed": _with(_DETAIL_PAYLOADS) + f"""
SELECT '{INGESTED_AT}' AS ingested_at, appid, success,
  CASE WHEN with_data THEN '{{"steam_appid":' || appid || ',"type":"game","name":"' || p_name
    || '","is_free":' || CAST(l_linenumber = 1 AS VARCHAR) || ',"required_age":0,"developers":["' || p_brand
    || '"],"publishers":["' || CASE WHEN l_linenumber % 2 = 0 THEN p_brand ELSE 'Supplier ' || l_suppkey END
    || '"],"price_overview":{{"currency":"USD","final":' || (cents - 100 * l_linenumber)
    || ',"initial":' || cents || '}},"platforms":null,"categories":['
    || concat_ws(',', CASE WHEN l_quantity >= 25 THEN '{{"description":"Multi-player","id":1}}' END,
         CASE WHEN CAST(l_quantity AS BIGINT) % 2 = 0 THEN '{{"description":"Co-op","id":9}}' END)
    || '],"genres":[' || concat_ws(',', '{{"description":"' || split_part(p_name, ' ', 1) || '","id":"1"}}',
         '{{"description":"' || split_part(p_name, ' ', 2) || '","id":"2"}}',
         CASE WHEN p_type = 'ECONOMY' THEN '{{"description":"Indie","id":"23"}}' END)
    || '],"recommendations":null,"release_date":{{"coming_soon":' || CAST(l_linestatus = 'O' AS VARCHAR)
    || ',"date":"' || CASE l_linenumber WHEN 2 THEN 'Q1 1999' WHEN 3 THEN 'Coming soon'
         ELSE strftime(o_orderdate, '%b %-d, %Y') END
    || '"}},"metacritic":null,"content_descriptors":null}}'
  WHEN success THEN '{{' || array_to_string(['"' || x || '":null' FOR x IN [{", ".join(repr(x) for x in TRIMMED_DETAIL_KEYS)}]], ',') || '}}'
  END AS raw,
  CASE WHEN error IS NOT NULL THEN '{{"error":"' || error || '"}}' WHEN success THEN NULL
       WHEN k = 5 THEN '{{}}' ELSE '{{"success":false}}' END AS error_payload
FROM c""",
    "failed_details": _with(_DETAIL_PAYLOADS) + """
SELECT appid FROM c WHERE error IS NOT NULL""",
    "ingest_reviews": _with(_REVIEW_PAYLOADS) + """
SELECT appid, success,
  CASE WHEN with_qs THEN total END AS total_reviews,
  CASE WHEN with_qs THEN o_orderkey % (total + 1) END AS good_reviews,
  CASE WHEN with_qs THEN total - o_orderkey % (total + 1) END AS bad_reviews,
  CASE WHEN with_qs THEN o_orderkey % 10 END AS review_score,
  CASE WHEN with_qs THEN o_orderpriority END AS review_score_desc,
  CASE WHEN with_qs THEN least(total, 20) END AS num_reviews_returned,
  error
FROM d""",
    "catalog_from_pages": f"""
SELECT p_partkey AS appid, p_name AS name,
       CAST(p_size AS BIGINT) * 1000 AS last_modified,
       p_partkey % 13 AS price_change_number,
       DATE '{AS_OF}' AS partition_date,
       'steam_istoreservice_getapplist_v1' AS source
FROM part""",
    "load_day_reviews": _with(_REVIEWS) + """
SELECT appid, ingestion_date, success, total_reviews, good_reviews, review_score_desc,
       CAST(NULL AS VARCHAR) AS name
FROM reviews""",
    "load_day_catalog": _with(_CATALOG) + """
SELECT appid, name, partition_date FROM catalog""",
})
ORACLE_SQL["publish_day_reviews"] = ORACLE_SQL["load_day_reviews"]
ORACLE_SQL["view_stg_catalog"] = ORACLE_SQL["bucketed_stg_catalog"] = ORACLE_SQL["stg_catalog"]
ORACLE_SQL["view_stg_reviews"] = ORACLE_SQL["stg_reviews"]
ORACLE_SQL["view_stg_appdetails"] = ORACLE_SQL["stg_appdetails"]
ORACLE_SQL["build_all_genres"] = ORACLE_SQL["mart_genres"]
ORACLE_SQL["limit_pending_published"] = ORACLE_SQL["limit_pending"].replace(
    "ingestion_date <=", "ingestion_date =")
ORACLE_SQL["failed_resumed"] = ORACLE_SQL["failed_details"]
ORACLE_SQL["table_raw_details"] = _with(_DETAILS) + """
SELECT appid, ingestion_date, success, name FROM details"""
ORACLE_SQL["publish_day_catalog"] = ORACLE_SQL["load_day_catalog"]
ORACLE_SQL["publish_day_details"] = _with(_DETAILS) + """
SELECT appid, ingestion_date, success, name FROM details"""
ORACLE_SQL["failed_reviews"] = _with(_REVIEW_PAYLOADS) + """
SELECT appid FROM c WHERE error IS NOT NULL"""
ORACLE_SQL["build_all_details_reviews"] = ORACLE_SQL["mart_details_reviews"]
ORACLE_SQL["limit_pending_counts"] = ORACLE_SQL["limit_pending"]
for _model in ("stg_catalog", "stg_appdetails", "stg_reviews"):
    ORACLE_SQL[_model + "_ties"] = ORACLE_SQL[_model]
ORACLE_SQL["mart_genres_today"] = ORACLE_SQL["mart_genres"].replace(f"DATE '{AS_OF}'", "current_date")
