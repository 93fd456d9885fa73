"""The registered queries as SQL, for comparison by another engine.

Written from the definition of each result, without the steps the operators
take to get there: no blocks, no cut of neighbours, no spellings of the log.
"""

from __future__ import annotations

from basketflow.plans.queries import SECOND_LOAD

SHOP = """
log AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS session_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CASE l_returnflag WHEN 'A' THEN 'view' WHEN 'N' THEN 'cart' ELSE 'purchase' END AS event_type,
         CAST(l_partkey AS VARCHAR) AS product_id, p_type AS category,
         o_orderdate AS ordered_on
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
"""

CLICKS = """
log AS (
  SELECT CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') AS session_id,
         CAST(user_id AS VARCHAR) AS user_id,
         CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
         json_extract_string(props, '$.k') AS product_id,
         CAST(CAST(json_extract_string(props, '$.k') AS INT) // 20 AS VARCHAR) AS category
  FROM events)
"""

BASKETS = """
baskets AS (SELECT DISTINCT session_id, product_id FROM log WHERE event_type = 'purchase')
"""

BASKET_PAIRS = """
basket_pairs AS (
  SELECT a.session_id, a.product_id AS item_a, b.product_id AS item_b
  FROM baskets a JOIN baskets b ON a.session_id = b.session_id AND a.product_id < b.product_id)
"""

PAIRS = """
pairs AS (SELECT item_a, item_b, count(*) AS count FROM basket_pairs GROUP BY ALL)
"""

EDGES = """
edges AS (
  SELECT item_a AS source_item, item_b AS item, count FROM pairs
  UNION ALL SELECT item_b, item_a, count FROM pairs)
"""

SCORES = """
weighted AS (
  SELECT user_id, category,
         CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 3 ELSE 5 END AS weight
  FROM log WHERE event_type IN ('view', 'cart', 'purchase')),
scores AS (
  SELECT user_id, category, CAST(sum(weight) AS BIGINT) AS score FROM weighted GROUP BY ALL),
affinity AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, category) AS INT) AS rank
  FROM scores)
"""

TOP = """
top AS (
  SELECT user_id, string_agg(category, ',' ORDER BY rank) AS user_top_categories
  FROM affinity WHERE rank <= 3 GROUP BY user_id)
"""

ITEMS = """
item_scores AS (
  SELECT user_id, product_id,
         CAST(sum(CASE event_type WHEN 'cart' THEN 1 ELSE 2 END) AS BIGINT) AS score
  FROM log WHERE event_type IN ('cart', 'purchase') GROUP BY ALL),
ranked_items AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank
  FROM item_scores),
source_items AS (SELECT * FROM ranked_items WHERE rank <= 20)
"""

RECOMMENDATIONS = """
foreign_items AS (
  SELECT s.user_id, s.rank AS source_rank, s.product_id AS source_item, e.item, e.count
  FROM source_items s JOIN edges e ON e.source_item = s.product_id
  WHERE NOT EXISTS (
    SELECT 1 FROM source_items o WHERE o.user_id = s.user_id AND o.product_id = e.item)),
ranked_recs AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY user_id, source_item ORDER BY count DESC, item) AS INT) AS rank
  FROM foreign_items),
recs AS (SELECT * FROM ranked_recs WHERE rank <= 5)
"""

PROFILES = """
blocks AS (
  SELECT user_id, source_rank, source_item, count(*) AS n_co_items,
         string_agg(item || ':' || count, ',' ORDER BY rank) AS co_items
  FROM recs GROUP BY ALL),
nested_recs AS (
  SELECT user_id,
         string_agg(source_item || '=' || co_items, ';' ORDER BY source_rank) AS recommendations,
         string_agg(source_item, ',' ORDER BY source_rank) AS available
  FROM blocks GROUP BY user_id),
nested_affinity AS (
  SELECT user_id,
         string_agg(rank || ':' || category || ':' || score, ',' ORDER BY rank) AS top_categories
  FROM affinity GROUP BY user_id),
profiles AS (
  SELECT user_id, top_categories, coalesce(recommendations, '') AS recommendations,
         coalesce(available, '') AS available
  FROM nested_affinity LEFT JOIN nested_recs USING (user_id))
"""

ABANDONED = """
sessions AS (
  SELECT session_id, bool_or(event_type = 'cart') AS has_cart,
         bool_or(event_type = 'purchase') AS has_purchase,
         count(*) FILTER (event_type = 'cart' AND category IS NOT NULL) AS n_cart_events
  FROM log GROUP BY session_id),
abandoned AS (
  SELECT session_id, n_cart_events FROM sessions
  WHERE has_cart AND NOT has_purchase AND n_cart_events > 0),
cart_items AS (
  SELECT DISTINCT user_id, session_id, product_id, category AS abandoned_category
  FROM log WHERE event_type = 'cart' AND session_id IN (SELECT session_id FROM abandoned)),
flagged AS (
  SELECT i.user_id, session_id, product_id, abandoned_category,
         coalesce(user_top_categories, '') AS user_top_categories,
         CASE WHEN EXISTS (SELECT 1 FROM affinity f WHERE f.user_id = i.user_id AND f.rank <= 3
                             AND f.category = i.abandoned_category)
              THEN 'High_Discount' ELSE 'Standard_Reminder' END AS flag
  FROM cart_items i LEFT JOIN top t ON t.user_id = i.user_id)
"""

REQUESTS = """
requests AS (
  SELECT user_id, product_id AS item_id FROM source_items WHERE rank = 1
  UNION ALL SELECT user_id, min(product_id) FROM log WHERE event_type = 'view' GROUP BY user_id
  UNION ALL SELECT s_name, CAST(s_suppkey AS VARCHAR) FROM supplier)
"""

LOOKUPS = """
global_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source_item ORDER BY count DESC, item) AS place FROM edges),
fallback AS (
  SELECT source_item, string_agg(item || ':' || count, ',' ORDER BY place) AS co_items
  FROM global_ranked WHERE place <= 5 GROUP BY source_item),
answers AS (
  SELECT r.user_id, r.item_id, p.user_id IS NOT NULL AS found_user,
         b.source_item IS NOT NULL AS found_embedded_source_item,
         p.user_id IS NOT NULL AND b.source_item IS NULL AS used_global_fallback,
         coalesce(p.top_categories, '') AS top_categories,
         CASE WHEN p.user_id IS NULL THEN '' WHEN b.source_item IS NOT NULL THEN b.co_items
              ELSE coalesce(f.co_items, '') END AS recommendations,
         coalesce(p.available, '') AS available_source_items,
         b.co_items AS embedded, coalesce(f.co_items, '') AS everyone
  FROM requests r
  LEFT JOIN profiles p ON p.user_id = r.user_id
  LEFT JOIN blocks b ON b.user_id = r.user_id AND b.source_item = r.item_id
  LEFT JOIN fallback f ON f.source_item = r.item_id)
"""

RAW = """
SELECT CAST(l_orderkey AS VARCHAR) AS session_id, CAST(o_custkey AS VARCHAR) || ' ' AS user_id,
       CASE l_returnflag WHEN 'A' THEN 'view' WHEN 'N' THEN ' Cart ' ELSE 'PURCHASE' || chr(9) END AS event_type,
       CAST(l_partkey AS VARCHAR) AS product_id, l_extendedprice AS price,
       CASE p_partkey % 50
         WHEN 7 THEN '{""category"": ""' || p_type || '"", ""brand"": ""' || p_brand || '""}'
         WHEN 8 THEN '{"brand": "' || p_brand || '", "category": "' || p_type || '", "cut'
         WHEN 9 THEN '{"brand":"' || p_brand || '","product_category":"' || p_type || '"}'
         ELSE '{"category":"' || p_type || '","brand":"' || p_brand || '"}' END AS product_metadata
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""

CATEGORY_CASES = """
SELECT p_partkey, CASE p_partkey % 21
    WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 9 THEN CAST(p_partkey AS VARCHAR)
    WHEN 10 THEN NULL WHEN 11 THEN NULL WHEN 12 THEN NULL WHEN 13 THEN NULL
    WHEN 14 THEN NULL WHEN 15 THEN NULL WHEN 16 THEN NULL
    ELSE p_type END AS category
FROM part
"""

JSON_ANSWERS = """
SELECT '{"user_id":"' || a.user_id || '","item_id":"' || item_id
       || '","found_user":' || found_user
       || ',"found_embedded_source_item":' || found_embedded_source_item
       || ',"found_item_recommendations":' || (recommendations <> '')
       || ',"used_global_fallback":' || used_global_fallback
       || ',"top_categories":[' || coalesce((
            SELECT string_agg('{"rank":' || rank || ',"category":"' || category || '","score":' || score || '}',
                              ',' ORDER BY rank) FROM affinity f WHERE f.user_id = a.user_id), '')
       || '],"recommendations":['
       || regexp_replace(recommendations, '([^:,]+):([0-9]+)', '{"item":"\\1","count":\\2}', 'g')
       || '],"available_source_items":['
       || CASE WHEN available_source_items = '' THEN '' ELSE
            '"' || replace(available_source_items, ',', '","') || '"' END
       || '],"profile_updated_at":'
       || CASE WHEN found_user THEN '"2026-01-01T00:00:00.000000+00:00"' ELSE 'null' END || '}' AS json
FROM answers a
"""


def _with(*parts_and_select: str) -> str:
    *parts, select = parts_and_select
    return "WITH " + ",".join(parts) + select


_TO_PAIRS = (BASKETS, BASKET_PAIRS, PAIRS)
_TO_RECS = (*_TO_PAIRS, EDGES, ITEMS, RECOMMENDATIONS)
_TO_PROFILES = (*_TO_RECS, SCORES, PROFILES)
_TO_FLAGS = (SCORES, TOP, ABANDONED)
_TO_ANSWERS = (*_TO_PROFILES, REQUESTS, LOOKUPS)

def _two_loads(parts: tuple[str, ...], result: str, select: str) -> str:
    """``select`` over ``result`` of the first load (one) and of the second (two)."""
    loads = []
    for name, side in (("one", "<"), ("two", ">=")):
        log = f"log AS (SELECT * FROM whole WHERE ordered_on {side} DATE '{SECOND_LOAD}')"
        loads.append(f"{name} AS ({_with(log, *parts, 'SELECT * FROM ' + result)})")
    return _with(SHOP, "whole AS (SELECT * FROM log)", *loads, select)


_EVENTS = "SELECT session_id, user_id, event_type, product_id, category FROM log"
_RECS = "SELECT user_id, source_rank, source_item, rank, item, count FROM recs"
_SECOND_RUN_TS = " '2026-01-02T00:00:00.000000+00:00' "
_RUN_TS = " '2026-01-01T00:00:00.000000+00:00' "
_FLAGGED = "SELECT *," + _RUN_TS + "AS generated_at FROM flagged"

ORACLES: dict[str, str] = {
    "scan_events": RAW,
    "scan_events_csv": RAW,
    "events_norm": _with(SHOP, _EVENTS),
    "events_norm_stored": _with(SHOP, _EVENTS + " WHERE event_type IN ('cart', 'purchase')"),
    "extract_category": CATEGORY_CASES,
    "purchases": _with(SHOP, "SELECT session_id, product_id FROM log WHERE event_type = 'purchase'"),
    "weighted_events": _with(SHOP, SCORES, "SELECT user_id, category, weight FROM weighted"),
    "session_events": _with(SHOP, _EVENTS),
    "session_baskets": _with(SHOP, BASKETS, "SELECT * FROM baskets"),
    "basket_sizes": _with(
        SHOP, BASKETS, "SELECT session_id, count(*) AS n_products FROM baskets GROUP BY session_id"
    ),
    "basket_pairs": _with(SHOP, BASKETS, BASKET_PAIRS, "SELECT * FROM basket_pairs"),
    "pair_counts": _with(SHOP, *_TO_PAIRS, "SELECT * FROM pairs"),
    "pairs_ranked": _with(
        SHOP, *_TO_PAIRS, "SELECT * FROM pairs ORDER BY count DESC, item_a, item_b"
    ),
    "top_pairs": _with(
        SHOP, *_TO_PAIRS, "SELECT * FROM pairs ORDER BY count DESC, item_a, item_b LIMIT 20"
    ),
    "pair_documents": _with(
        SHOP,
        *_TO_PAIRS,
        "SELECT item_a || '::' || item_b AS pair_id, item_a, item_b,"
        " item_a || ',' || item_b AS items, count," + _RUN_TS + "AS updated_at FROM pairs",
    ),
    "pairs_with_item": _with(
        SHOP,
        *_TO_PAIRS,
        """
        SELECT w.product_id AS item_id, item_a || '::' || item_b AS pair_id,
               CASE WHEN item_a = w.product_id THEN item_b ELSE item_a END AS other_item, count
        FROM (SELECT DISTINCT product_id FROM log WHERE event_type = 'cart') w
        JOIN pairs ON w.product_id = item_a OR w.product_id = item_b""",
    ),
    "co_occurrence_edges": _with(SHOP, *_TO_PAIRS, EDGES, "SELECT * FROM edges"),
    "handoff_pairs": _with(SHOP, *_TO_PAIRS, "SELECT * FROM pairs"),
    "user_category_scores": _with(SHOP, SCORES, "SELECT * FROM scores"),
    "user_affinity": _with(SHOP, SCORES, "SELECT * FROM affinity"),
    "user_affinity_nested": _with(
        SHOP,
        SCORES,
        "SELECT user_id, string_agg(rank || ':' || category || ':' || score, ',' ORDER BY rank)"
        " AS top_categories FROM affinity GROUP BY user_id",
    ),
    "top_categories": _with(SHOP, SCORES, TOP, "SELECT * FROM top"),
    "profile_top_categories": _with(SHOP, SCORES, TOP, "SELECT * FROM top"),
    "user_item_scores": _with(SHOP, ITEMS, "SELECT * FROM item_scores"),
    "user_source_items": _with(SHOP, ITEMS, "SELECT * FROM source_items"),
    "user_source_items_nested": _with(
        SHOP,
        ITEMS,
        "SELECT user_id, string_agg(product_id, ',' ORDER BY rank) AS source_items"
        " FROM source_items GROUP BY user_id",
    ),
    "scan_source_items_faults": _with(
        SHOP,
        ITEMS,
        """
        SELECT user_id, string_agg(product_id, ',' ORDER BY rank) AS source_items, NULL AS reason
        FROM source_items GROUP BY user_id
        UNION ALL SELECT s_name, '', NULL FROM supplier
        UNION ALL SELECT DISTINCT user_id, NULL, 'replaced' FROM source_items
        UNION ALL SELECT NULL, NULL, unnest(['no object', 'no object', 'no user']) FROM supplier""",
    ),
    "scan_source_items_json": _with(
        SHOP,
        ITEMS,
        "SELECT user_id, string_agg(product_id, ',' ORDER BY rank) AS source_items"
        " FROM source_items GROUP BY user_id",
    ),
    "top_co_items": _with(
        SHOP,
        *_TO_PAIRS,
        EDGES,
        """
        SELECT * FROM (
          SELECT source_item, item, count, CAST(row_number() OVER (
            PARTITION BY source_item ORDER BY count DESC, item) AS INT) AS rank FROM edges)
        WHERE rank <= 5""",
    ),
    "candidate_recommendations": _with(
        SHOP,
        *_TO_PAIRS,
        EDGES,
        ITEMS,
        """
        SELECT s.user_id, s.rank AS source_rank, s.product_id AS source_item, n.item, n.count
        FROM source_items s JOIN edges n ON n.source_item = s.product_id
        WHERE NOT EXISTS (
          SELECT 1 FROM source_items o WHERE o.user_id = s.user_id AND o.product_id = n.item)""",
    ),
    "user_recommendations": _with(SHOP, *_TO_RECS, _RECS),
    "user_recommendations_wide": _with(
        SHOP,
        *_TO_PAIRS,
        EDGES,
        ITEMS.replace("rank <= 20", "rank <= 30"),
        RECOMMENDATIONS.replace("rank <= 5", "rank <= 10"),
        _RECS,
    ),
    "user_recommendations_nested": _with(
        SHOP, *_TO_PROFILES, "SELECT user_id, recommendations FROM nested_recs"
    ),
    "user_profiles_flat": _with(
        SHOP,
        *_TO_PROFILES,
        """
        SELECT c.user_id, n_categories, best_category, best_score,
               coalesce(n_blocks, 0) AS n_blocks, coalesce(n_co_items, 0) AS n_co_items
        FROM (SELECT user_id, count(*) AS n_categories, max(score) AS best_score,
                     max(category) FILTER (rank = 1) AS best_category
              FROM affinity GROUP BY user_id) c
        LEFT JOIN (SELECT user_id, count(*) AS n_blocks, CAST(sum(n_co_items) AS BIGINT) AS n_co_items
                   FROM blocks GROUP BY user_id) b ON b.user_id = c.user_id""",
    ),
    "user_profiles_nested": _with(
        SHOP, *_TO_PROFILES, "SELECT user_id, top_categories, recommendations FROM profiles"
    ),
    "profiles_exploded": _with(
        SHOP,
        *_TO_RECS,
        """
        SELECT user_id, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY source_rank) AS INT) AS block,
               source_item, rank AS position, item, count
        FROM recs""",
    ),
    "upsert_pairs": _two_loads(
        _TO_PAIRS,
        "pairs",
        """
        SELECT item_a || '::' || item_b AS pair_id, item_a, item_b, count,"""
        + _SECOND_RUN_TS
        + """AS updated_at FROM two
        UNION ALL
        SELECT item_a || '::' || item_b, item_a, item_b, count,"""
        + _RUN_TS
        + """FROM one
        WHERE NOT EXISTS (
          SELECT 1 FROM two WHERE two.item_a = one.item_a AND two.item_b = one.item_b)""",
    ),
    "upsert_profiles": _two_loads(
        _TO_PROFILES,
        "profiles",
        """
        SELECT user_id, top_categories, recommendations,"""
        + _SECOND_RUN_TS
        + """AS updated_at FROM two
        UNION ALL
        SELECT user_id, top_categories, recommendations,"""
        + _RUN_TS
        + """FROM one
        WHERE user_id NOT IN (SELECT user_id FROM two)""",
    ),
    "upsert_metrics": _two_loads(
        _TO_PAIRS,
        "pairs",
        """
        SELECT count(*) FILTER (one.item_a IS NOT NULL AND two.item_a IS NOT NULL) AS matched,
               count(*) FILTER (one.item_a IS NOT NULL AND two.item_a IS NOT NULL) AS modified,
               count(*) FILTER (one.item_a IS NULL) AS inserted,
               count(*) FILTER (two.item_a IS NULL) AS kept
        FROM one FULL JOIN two ON two.item_a = one.item_a AND two.item_b = one.item_b""",
    ),
    "session_summary": _with(SHOP, *_TO_FLAGS, "SELECT * FROM sessions"),
    "abandoned_sessions": _with(SHOP, *_TO_FLAGS, "SELECT * FROM abandoned"),
    "abandoned_cart_items": _with(SHOP, *_TO_FLAGS, "SELECT * FROM cart_items"),
    "flag_abandoned_items": _with(SHOP, *_TO_FLAGS, _FLAGGED),
    "flag_distribution": _with(
        SHOP, *_TO_FLAGS, "SELECT flag, count(*) AS n_items FROM flagged GROUP BY flag"
    ),
    "abandonment_summary": _with(
        SHOP,
        *_TO_FLAGS,
        """
        SELECT 'abandoned_sessions' AS metric, count(*) AS value FROM abandoned
        UNION ALL SELECT 'abandoned_cart_items', count(*) FROM cart_items
        UNION ALL SELECT flag, count(*) FROM flagged GROUP BY flag
        UNION ALL SELECT 'user_profiles', count(DISTINCT user_id) FROM scores""",
    ),
    "lookup_profile": _with(
        SHOP, *_TO_ANSWERS, "SELECT user_id, item_id, found_user, top_categories FROM answers"
    ),
    "lookup_embedded": _with(
        SHOP,
        *_TO_ANSWERS,
        "SELECT user_id, item_id, embedded AS recommendations FROM answers"
        " WHERE found_embedded_source_item",
    ),
    "lookup_available_items": _with(
        SHOP, *_TO_PROFILES, "SELECT user_id, available AS available_source_items FROM profiles"
    ),
    "global_recommendations": _with(
        SHOP, *_TO_ANSWERS, "SELECT user_id, item_id, everyone AS recommendations FROM answers"
    ),
    "lookup_batch": _with(
        SHOP,
        *_TO_ANSWERS,
        """
        SELECT user_id, item_id, found_user, found_embedded_source_item,
               recommendations <> '' AS found_item_recommendations, used_global_fallback,
               top_categories, recommendations, available_source_items
        FROM answers""",
    ),
    "lookup_by_index": _with(
        SHOP,
        *_TO_PROFILES,
        "asked AS (SELECT CAST(s_suppkey AS VARCHAR) AS item FROM supplier)",
        """
        SELECT 'user_id' AS kind, user_id AS term, user_id AS key FROM profiles
        UNION ALL SELECT DISTINCT 'category', category, user_id FROM affinity
        UNION ALL SELECT DISTINCT 'source_item', source_item, user_id FROM recs
          WHERE source_item IN (FROM asked) AND user_id IN (SELECT user_id FROM affinity)
        UNION ALL SELECT DISTINCT 'co_item', item, user_id FROM recs
          WHERE item IN (FROM asked) AND user_id IN (SELECT user_id FROM affinity)
        UNION ALL SELECT 'item', item_a, item_a || '::' || item_b FROM pairs WHERE item_a IN (FROM asked)
        UNION ALL SELECT 'item', item_b, item_a || '::' || item_b FROM pairs WHERE item_b IN (FROM asked)
        UNION ALL SELECT 'count', lpad(CAST(count AS VARCHAR), 19, '0'), item_a || '::' || item_b
          FROM pairs WHERE count >= 2""",
    ),
    "lookup_json": _with(SHOP, *_TO_ANSWERS, JSON_ANSWERS),
    "click_events_norm": _with(CLICKS, _EVENTS),
    "click_pairs_ranked": _with(
        CLICKS, *_TO_PAIRS, "SELECT * FROM pairs ORDER BY count DESC, item_a, item_b"
    ),
    "click_pairs_in_blocks": _with(CLICKS, *_TO_PAIRS, "SELECT * FROM pairs"),
    "click_user_affinity": _with(CLICKS, SCORES, "SELECT * FROM affinity"),
    "click_user_source_items": _with(CLICKS, ITEMS, "SELECT * FROM source_items"),
    "click_user_recommendations": _with(CLICKS, *_TO_RECS, _RECS),
    "click_flag_abandoned_items": _with(CLICKS, *_TO_FLAGS, _FLAGGED),
}
