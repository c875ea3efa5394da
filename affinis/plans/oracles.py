"""The registered queries as plain SQL, for another engine to check."""

from __future__ import annotations

from affinis.plans.views import AS_OF, with_views

ORACLES: dict[str, str] = {}

_TIME = "strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp"
_ORDER = "timestamp, ord, line, item_id, rating, event_type"


def _mean(column: str, scale: int = 1_000_000) -> str:
    return (
        f"CAST(sum(CAST(round({column} * {scale}) AS BIGINT)) AS DOUBLE)"
        f" / nullif(count({column}) * CAST({scale} AS DOUBLE), 0)"
    )


def _add(name: str, views: str, select: str, *ctes: str) -> None:
    ORACLES[name] = with_views(views, *ctes, select=select)


# -- sources and sinks ---------------------------------------------------------------
_add("scan_interactions", "ix_raw", "SELECT * FROM ix_raw")
_add(
    "scan_interactions_by_header",
    "ix_raw",
    """SELECT * FROM ix_raw WHERE seq % 3 = 0 UNION ALL
       SELECT user_id, item_id, rating, timestamp, NULL, seq FROM ix_raw WHERE seq % 3 = 1 UNION ALL
       SELECT * FROM ix_raw WHERE seq % 3 = 2 AND seq % 2 <> 0 AND rating IS NULL""",
)
_add(
    "reject_counts",
    "ix_raw",
    "SELECT 'rating' AS reason, count(*) AS lines FROM ix_raw WHERE seq % 3 = 2 AND (seq % 2 = 0 OR rating IS NOT NULL)",
)
_add(
    "scan_products_json",
    "products",
    """SELECT item_id, title, coalesce(category, 'unknown') AS category,
              CASE WHEN item_id % 2 = 0 THEN 'unknown' ELSE brand END AS brand,
              price, rating, rating_count,
              CASE WHEN item_id % 2 = 0 THEN true ELSE coalesce(in_stock, true) END AS in_stock
       FROM products""",
)
_add(
    "scan_latest_snapshot",
    "products",
    "SELECT * REPLACE (price * 2 AS price), 's2' AS ingest_ts FROM products",
)
_add("write_raw_snapshot", "ix_raw", "SELECT *, 's1' AS ingest_ts FROM ix_raw")
_add(
    "write_processed_snapshot",
    "ix_clean",
    f"SELECT * REPLACE ({_TIME}), 's1' AS ingest_ts FROM ix_clean",
)

_USER_FEATURES = f"""
    SELECT user_id, count(item_id) AS total_interactions,
           count(DISTINCT item_id) AS unique_items,
           round_even({_mean('rating')}, 4) AS avg_rating_given,
           round_even(coalesce(stddev_samp(rating), 0), 4) AS std_rating_given,
           count(*) FILTER (event_type = 'purchase') AS purchase_count,
           count(*) FILTER (event_type = 'view') AS view_count,
           count(*) FILTER (event_type = 'wishlist') AS wishlist_count,
           count(*) FILTER (event_type = 'cart') AS cart_count,
           CAST(4 * count(*) FILTER (event_type = 'purchase')
                + 2 * count(*) FILTER (event_type = 'wishlist')
                + 2 * count(*) FILTER (event_type = 'cart')
                + count(*) FILTER (event_type = 'view') AS BIGINT) AS activity_score,
           round_even(coalesce(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(timestamp)) AS DOUBLE)
                               / 1e6 / 86400, 999), 2) AS recency_days,
           '{AS_OF}' AS created_at
    FROM {{source}} WHERE user_id IS NOT NULL GROUP BY user_id"""
_ITEM_ACTIVITY = f"""
    SELECT item_id, count(user_id) AS total_interactions,
           count(DISTINCT user_id) AS unique_users,
           {_mean('rating')} AS avg_rating_received, stddev_samp(rating) AS std_rating_received
    FROM {{source}} WHERE item_id IS NOT NULL GROUP BY item_id"""
_POPULAR = """
    SELECT *, round_even((ln(1 + total_interactions) - (SELECT ln(1 + min(total_interactions)) FROM {source}))
                    / ((SELECT ln(1 + max(total_interactions)) FROM {source})
                       - (SELECT ln(1 + min(total_interactions)) FROM {source}) + 1e-9), 4)
              AS popularity_score
    FROM {source}"""


def _item_features(source: str) -> list[str]:
    return [
        f"activity AS ({_ITEM_ACTIVITY.format(source=source)})",
        f"popular AS ({_POPULAR.format(source='activity')})",
        f"""item_feats AS (
            SELECT p.item_id, total_interactions, unique_users,
                   round_even(avg_rating_received, 4) AS avg_rating_received,
                   round_even(coalesce(std_rating_received, 0), 4) AS std_rating_received,
                   popularity_score, category, price, price_normalized, brand, category_encoded,
                   '{AS_OF}' AS created_at
            FROM popular p LEFT JOIN products_encoded c ON p.item_id = c.item_id)""",
    ]


def _pairs(source: str) -> list[str]:
    return [
        f"baskets AS (SELECT DISTINCT user_id, item_id FROM {source})",
        "degrees AS (SELECT item_id, count(*) AS degree FROM baskets GROUP BY item_id)",
        """pairs AS (
            SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS cooccur_count
            FROM baskets a JOIN baskets b ON a.user_id = b.user_id AND a.item_id < b.item_id
            GROUP BY 1, 2 HAVING count(*) >= 2)""",
        """jaccard AS (
            SELECT item_a, item_b, cooccur_count,
                   round_even(cooccur_count / (da.degree + db.degree - cooccur_count), 4)
                   AS jaccard_similarity
            FROM pairs JOIN degrees da ON item_a = da.item_id JOIN degrees db ON item_b = db.item_id)""",
    ]


_INTERACTION_FEATURES = """
    SELECT c.user_id, c.item_id, c.rating,
           CAST(hour(timestamp) AS BIGINT) AS hour_of_day,
           CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week,
           CAST(CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
           round_even(CAST(CAST(round(c.rating * 1000000) AS BIGINT) * u.n - u.s AS DOUBLE)
                      / (u.n * CAST(1000000 AS DOUBLE)), 4) AS user_item_gap,
           event_type, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp
    FROM ix_clean c JOIN (
        SELECT user_id, sum(CAST(round(rating * 1000000) AS BIGINT)) AS s, count(rating) AS n
        FROM ix_clean GROUP BY user_id) u ON c.user_id = u.user_id"""

_add(
    "write_feature_tables",
    "ix_clean products_encoded",
    """SELECT 'user_features' AS "table", count(*) AS rows, CAST(sum(total_interactions) AS BIGINT) AS total
       FROM user_feats
       UNION ALL SELECT 'item_features', count(*), CAST(sum(total_interactions) AS BIGINT) FROM item_feats
       UNION ALL SELECT 'interaction_features', count(*), CAST(sum(item_id) AS BIGINT) FROM ix_clean
       UNION ALL SELECT 'item_cooccurrence', count(*), CAST(sum(cooccur_count) AS BIGINT) FROM jaccard""",
    f"user_feats AS ({_USER_FEATURES.format(source='ix_clean')})",
    *_item_features("ix_clean"),
    *_pairs("ix_clean"),
)
_add("read_feature_table", "ix_clean", _USER_FEATURES.format(source="ix_clean"))


def _u(digest: str, part: int) -> str:
    return f"(CAST(('0x' || substr({digest}, {8 * part + 1}, 8)) AS UBIGINT) / CAST(4294967296 AS DOUBLE))"


def _choice(draw: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST(floor({draw} * {len(values)}) AS BIGINT) + 1]"


_add(
    "require_columns",
    "ix_raw",
    """SELECT 'user_id' AS required_column, true AS present, count(user_id) AS non_null FROM ix_raw
       UNION ALL SELECT 'item_id', true, count(item_id) FROM ix_raw
       UNION ALL SELECT 'rating', true, count(rating) FROM ix_raw
       UNION ALL SELECT 'timestamp', true, count(timestamp) FROM ix_raw
       UNION ALL SELECT 'channel', false, 0""",
)
_add(
    "null_counts",
    "ix_raw",
    """SELECT 4 * count(*) - count(user_id) - count(item_id) - count(rating) - count(timestamp)
       AS null_count FROM ix_raw""",
)
_add(
    "duplicate_key_count",
    "ix_orders",
    """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_count
       FROM (SELECT count(*) AS n FROM ix_orders GROUP BY user_id, item_id, timestamp)""",
)
def _checksum(view: str, *columns: str) -> str:
    parts = " || ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns)
    return f"""SELECT count(*) AS rows, CAST(sum(h) AS BIGINT) AS hash_sum, bit_xor(h) AS hash_xor FROM (
         SELECT CAST(CAST('0x' || substr(md5({parts}), 1, 8) AS UBIGINT) AS BIGINT) AS h
         FROM (SELECT * REPLACE ({_TIME}) FROM {view}))"""


_add(
    "table_checksum",
    "ix_orders",
    _checksum("ix_orders", "user_id", "item_id", "rating", "timestamp", "event_type", "ord", "line"),
)
_add(
    "table_checksum_md5",
    "ix_events",
    _checksum("ix_events", "user_id", "item_id", "rating", "timestamp", "event_type", "seq"),
)

# -- cleaning ---------------------------------------------------------------------------
_add("drop_null_keys", "ix_keyed", "SELECT * FROM ix_keyed")
_add("impute_group_median", "ix_filled", "SELECT * REPLACE (round(rating, 6) AS rating) FROM ix_filled")
_CLIPPED = "CASE WHEN rating < 1 THEN CAST(1 AS DOUBLE) WHEN rating > 5 THEN CAST(5 AS DOUBLE) ELSE rating END"
_add("clip_range", "ix_events", f"SELECT user_id, item_id, {_CLIPPED} AS rating, event_type, seq FROM ix_events")
_add("count_clipped", "ix_events", "SELECT count(*) FILTER (rating < 1 OR rating > 5) AS clipped FROM ix_events")
_add("normalize_types", "ix_events", f"SELECT * REPLACE (round_even(rating, 1) AS rating, {_TIME}) FROM ix_events")
_add(
    "parse_timestamps",
    "ix_raw",
    """SELECT * REPLACE (strftime(TRY_CAST(timestamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS timestamp)
       FROM ix_raw WHERE TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL""",
)
_add(
    "count_bad_timestamps",
    "ix_raw",
    "SELECT count(*) FILTER (TRY_CAST(timestamp AS TIMESTAMP) IS NULL) AS bad_timestamps FROM ix_raw",
)
_add(
    "fill_defaults",
    "products",
    "SELECT * REPLACE (coalesce(category, 'unknown') AS category, coalesce(in_stock, true) AS in_stock) FROM products",
)
_add(
    "repair_nonpositive",
    "products",
    """SELECT * REPLACE (CASE WHEN price <= 0 THEN (SELECT median(price) FROM products WHERE price > 0)
                              ELSE price END AS price) FROM products""",
)
_add("clean_interactions", "ix_clean", f"SELECT * REPLACE ({_TIME}) FROM ix_clean")
_add("clean_products", "products_clean", "SELECT * FROM products_clean")
_add(
    "dedup_keep_latest",
    "ix_raw",
    """SELECT * FROM ix_raw QUALIFY row_number() OVER (
         PARTITION BY user_id, item_id ORDER BY timestamp DESC NULLS FIRST, seq DESC) = 1""",
)
_add(
    "dedup_keep_latest_parsed",
    "ix_raw",
    """SELECT * FROM ix_raw QUALIFY row_number() OVER (
         PARTITION BY user_id, item_id
         ORDER BY TRY_CAST(timestamp AS TIMESTAMP) DESC NULLS LAST, seq DESC) = 1""",
)
_add(
    "dedup_keep_first",
    "ix_orders",
    f"""SELECT * REPLACE ({_TIME}) FROM ix_orders QUALIFY row_number() OVER (
          PARTITION BY user_id, item_id ORDER BY {_ORDER}) = 1""",
)
_add(
    "label_encode",
    "products",
    """SELECT *, CAST(dense_rank() OVER (ORDER BY coalesce(category, 'nan')) - 1 AS BIGINT) AS category_encoded,
              CAST(dense_rank() OVER (ORDER BY coalesce(brand, 'nan')) - 1 AS BIGINT) AS brand_encoded
       FROM products""",
)
_add(
    "min_max_scale",
    "products",
    """SELECT item_id, price, (price - (SELECT min(price) FROM products))
              / ((SELECT max(price) FROM products) - (SELECT min(price) FROM products)) AS price_normalized
       FROM products""",
)
_add("encode_products", "products_encoded", "SELECT * FROM products_encoded")
_add(
    "transform_products",
    "products_clean",
    """SELECT item_id, code AS category_encoded, round((price - low) / (high - low), 9) AS price_normalized
       FROM products_clean p
       LEFT JOIN (SELECT category, dense_rank() OVER (ORDER BY category) - 1 AS code
                  FROM (SELECT DISTINCT category FROM products_clean WHERE item_id % 2 = 0)) c USING (category),
       (SELECT min(price) AS low, max(price) AS high FROM products_clean WHERE item_id % 2 = 0) b""",
)

# -- features ------------------------------------------------------------------------------
_add(
    "user_activity_agg",
    "ix_clean",
    f"""SELECT user_id, count(item_id) AS total_interactions, count(DISTINCT item_id) AS unique_items,
               round_even({_mean('rating')}, 6) AS avg_rating_given,
               round_even(stddev_samp(rating), 6) AS std_rating_given,
               strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS last_interaction
        FROM ix_clean GROUP BY user_id""",
)
_EVENT_COUNTS = """
    SELECT user_id, count(*) FILTER (event_type = 'purchase') AS purchase_count,
           count(*) FILTER (event_type = 'view') AS view_count,
           count(*) FILTER (event_type = 'wishlist') AS wishlist_count,
           count(*) FILTER (event_type = 'cart') AS cart_count
    FROM ix_orders GROUP BY user_id"""
_add("event_type_counts", "ix_orders", _EVENT_COUNTS)
_add(
    "activity_score",
    "ix_orders",
    f"""SELECT user_id, CAST(4 * purchase_count + 2 * wishlist_count + 2 * cart_count + view_count AS BIGINT)
               AS activity_score FROM ({_EVENT_COUNTS})""",
)
_add(
    "recency_days",
    "ix_events",
    f"""SELECT user_id, round_even(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(timestamp)) AS DOUBLE)
               / 1e6 / 86400, 2) AS recency_days FROM ix_events GROUP BY user_id""",
)
_add("user_features", "ix_clean", _USER_FEATURES.format(source="ix_clean"))
_add(
    "item_activity_agg",
    "ix_orders",
    """SELECT * REPLACE (round_even(avg_rating_received, 6) AS avg_rating_received,
                         round_even(std_rating_received, 6) AS std_rating_received) FROM activity""",
    f"activity AS ({_ITEM_ACTIVITY.format(source='ix_orders')})",
)
_add(
    "popularity_score",
    "ix_orders",
    "SELECT item_id, total_interactions, popularity_score FROM popular",
    *_item_features("ix_orders")[:2],
)
_add(
    "item_features",
    "ix_orders products_encoded",
    "SELECT * REPLACE (round(price_normalized, 9) AS price_normalized) FROM item_feats",
    *_item_features("ix_orders"),
)
_add(
    "time_parts",
    "ix_events",
    """SELECT seq, CAST(hour(timestamp) AS BIGINT) AS hour_of_day,
              CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week,
              CAST(CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend
       FROM ix_events""",
)
_add(
    "user_rating_gap",
    "ix_orders",
    """SELECT o.user_id, item_id, rating, ord, line,
              round_even(CAST(CAST(round(rating * 1000000) AS BIGINT) * u.n - u.s AS DOUBLE)
                         / (u.n * CAST(1000000 AS DOUBLE)), 4) AS user_item_gap
       FROM ix_orders o JOIN (
           SELECT user_id, sum(CAST(round(rating * 1000000) AS BIGINT)) AS s, count(rating) AS n
           FROM ix_orders GROUP BY user_id) u ON o.user_id = u.user_id""",
)
_add("interaction_features", "ix_clean", _INTERACTION_FEATURES)
_add("item_cooccurrence", "ix_orders", "SELECT * FROM pairs", *_pairs("ix_orders")[:3])
_add("item_jaccard", "ix_orders", "SELECT * FROM jaccard", *_pairs("ix_orders"))
_add(
    "join_catalog",
    "ix_orders products",
    """SELECT i.item_id, i.interactions, p.category, p.price, p.price / 1000 AS price_normalized, p.brand
       FROM (SELECT item_id, count(user_id) AS interactions FROM ix_orders GROUP BY item_id) i
       LEFT JOIN products p ON i.item_id = p.item_id""",
)
_add(
    "join_event_counts",
    "ix_orders",
    """SELECT c_custkey AS user_id, count(o.user_id) AS wishlist_count
       FROM customer LEFT JOIN (SELECT user_id FROM ix_orders WHERE event_type = 'wishlist') o
            ON c_custkey = o.user_id GROUP BY c_custkey""",
)
_add(
    "semi_join_entities",
    "ix_orders products",
    """SELECT user_id, item_id, rating, event_type, ord, line FROM ix_orders
       WHERE item_id IN (SELECT item_id FROM products WHERE price <= 0)""",
)

_SPLIT = """parts AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp, seq) - 1
              >= (count(*) OVER (PARTITION BY user_id) * 4) // 5 AS is_test FROM ix_clean)"""
_EVALUATION = [
    _SPLIT,
    "train AS (SELECT * FROM parts WHERE NOT is_test)",
    "test AS (SELECT * FROM parts WHERE is_test)",
    """pool AS (
        SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS place
        FROM train GROUP BY item_id)""",
    """recs AS (
        SELECT u.user_id, p.item_id,
               row_number() OVER (PARTITION BY u.user_id ORDER BY p.place) AS rank
        FROM (SELECT DISTINCT user_id FROM test) u CROSS JOIN pool p
        WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id
                          AND t.item_id = p.item_id AND t.rating > 0)
        QUALIFY rank <= 10)""",
    "truth AS (SELECT DISTINCT user_id, item_id FROM test WHERE rating >= 3)",
    """scores AS (
        SELECT t.user_id, count(r.item_id) / 10 AS precision, count(r.item_id) / count(*) AS recall,
               coalesce(sum(1 / log2(r.rank + 1)), 0)
               / (SELECT sum(1 / log2(i + 1)) FROM range(1, 11) k(i) WHERE i <= min(t.n)) AS ndcg
        FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM truth) t
        LEFT JOIN recs r ON t.user_id = r.user_id AND t.item_id = r.item_id
        GROUP BY t.user_id)""",
]
_EVALUATION[-1] = """ideal AS (
        SELECT m.i AS n, sum(1 / log2(k.i + 1)) AS gain
        FROM range(1, 11) m(i) JOIN range(1, 11) k(i) ON k.i <= m.i GROUP BY m.i)"""
_EVALUATION.append("""scores AS (
        SELECT h.user_id, hits / 10 AS precision, hits / relevant AS recall, gained / gain AS ndcg
        FROM (SELECT t.user_id, count(r.item_id) AS hits, count(*) AS relevant,
                     coalesce(sum(1 / log2(r.rank + 1)), 0) AS gained
              FROM truth t LEFT JOIN recs r ON t.user_id = r.user_id AND t.item_id = r.item_id
              GROUP BY t.user_id) h
        JOIN ideal ON ideal.n = least(h.relevant, 10))""")
_add("anti_join_seen", "ix_clean", "SELECT * FROM recs", *_EVALUATION[:5])

# -- order, split, top-k ---------------------------------------------------------------------
_add(
    "sequence_in_user",
    "ix_orders",
    f"""SELECT user_id, item_id, ord, line,
               row_number() OVER (PARTITION BY user_id ORDER BY {_ORDER}) - 1 AS seq_in_user,
               count(*) OVER (PARTITION BY user_id) AS user_total FROM ix_orders""",
)
_add(
    "temporal_holdout_split",
    "ix_orders",
    f"""SELECT user_id, item_id, rating, event_type, ord, line,
               row_number() OVER (PARTITION BY user_id ORDER BY {_ORDER}) - 1
               >= (count(*) OVER (PARTITION BY user_id) * 4) // 5 AS is_test FROM ix_orders""",
)
_ITEM_COUNTS = "SELECT item_id, count(user_id) AS interactions FROM ix_orders GROUP BY item_id"
_add("top_items", "ix_orders", f"{_ITEM_COUNTS} ORDER BY interactions DESC, item_id LIMIT 20")
_add(
    "popularity_rank",
    "ix_orders",
    f"SELECT *, row_number() OVER (ORDER BY interactions DESC, item_id) AS rank FROM ({_ITEM_COUNTS})",
)

# -- quality --------------------------------------------------------------------------------------


def _rule(
    dataset: str, position: int, rule: str, column: str, view: str, failed: str,
    elements: str = "count(*)", observed: str = "CAST(NULL AS DOUBLE)",
) -> str:
    return f"""SELECT '{dataset}' AS dataset, CAST({position} AS BIGINT) AS position,
        '{rule}' AS expectation, '{column}' AS "column", {observed} AS observed,
        CAST({elements} AS BIGINT) AS element_count, CAST({failed} AS BIGINT) AS unexpected_count,
        round_even(CAST({failed} AS DOUBLE) * 100 / nullif(CAST({elements} AS DOUBLE), 0), 4) AS unexpected_pct,
        CASE WHEN {failed} = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {view}"""


def _unique(dataset: str, position: int, rule: str, columns: str, view: str) -> str:
    any_value = " OR ".join(f"{c} IS NOT NULL" for c in columns.split(","))
    groups = f"(SELECT count(*) AS n FROM {view} WHERE {any_value} GROUP BY {columns})"
    return _rule(
        dataset, position, rule, columns, groups,
        "coalesce(sum(n) FILTER (n > 1), 0)", "coalesce(sum(n), 0)",
    )


_I, _P = "interactions", "products"
_BAD_TIME = (
    "count(*) FILTER (timestamp IS NOT NULL AND try_strptime(timestamp, '%Y-%m-%d %H:%M:%S') IS NULL)"
)
_NONE = "CAST(0 AS DOUBLE)"
_RULES = {
    "expect_row_count_between": [
        _rule(_I, 1, "row_count_between", "", "ix_raw", "CAST(count(*) < 100 AS INT)",
              observed="CAST(count(*) AS DOUBLE)"),
        _rule(_P, 1, "row_count_between", "", "products", "CAST(count(*) < 10 AS INT)",
              observed="CAST(count(*) AS DOUBLE)"),
    ],
    "expect_columns_superset": [
        _rule(_I, 2, "columns_superset", "user_id,item_id,rating,timestamp", "ix_raw", "0", observed=_NONE),
        _rule(_P, 2, "columns_superset", "item_id,title,category,price", "products", "0", observed=_NONE),
    ],
    "expect_not_null": [
        *[_rule(_I, 3 + i, "not_null", c, "ix_raw", f"count(*) FILTER ({c} IS NULL)")
          for i, c in enumerate(["user_id", "item_id", "rating", "timestamp"])],
        *[_rule(_P, 3 + i, "not_null", c, "products", f"count(*) FILTER ({c} IS NULL)")
          for i, c in enumerate(["item_id", "title", "category", "price"])],
    ],
    "expect_between": [
        _rule(_I, 7, "between", "rating", "ix_raw", "count(*) FILTER (rating < 1 OR rating > 5)", "count(rating)"),
        _rule(_P, 8, "between", "price", "products", "count(*) FILTER (price < 0.01)", "count(price)"),
        _rule(_P, 10, "between", "rating", "products", "count(*) FILTER (rating < 0 OR rating > 5)", "count(rating)"),
    ],
    "expect_column_min_between": [
        _rule(_I, 8 + i, "column_min_between", c, "ix_raw", f"CAST(min({c}) < 1 AS INT)", f"count({c})",
              f"CAST(min({c}) AS DOUBLE)")
        for i, c in enumerate(["user_id", "item_id"])
    ],
    "expect_compound_unique": [_unique(_I, 10, "compound_unique", "user_id,item_id,timestamp", "ix_raw")],
    "expect_unique": [_unique(_P, 7, "unique", "item_id", "products")],
    "expect_strftime_format": [
        _rule(_I, 11, "strftime_format", "timestamp", "ix_raw", _BAD_TIME, "count(timestamp)")
    ],
    "expect_in_set": [
        _rule(_I, 12, "in_set", "event_type", "ix_raw",
              "count(*) FILTER (event_type NOT IN ('view', 'purchase', 'wishlist', 'cart'))", "count(event_type)"),
        _rule(_P, 9, "in_set", "category", "products",
              "count(*) FILTER (category NOT IN ('electronics', 'clothing', 'home', 'books', 'sports', 'beauty'))",
              "count(category)"),
    ],
}
for _name, _texts in _RULES.items():
    _all = " UNION ALL ".join(_texts)
    _add(_name, "ix_raw products", f"SELECT * EXCLUDE (position) FROM ({_all})")
_EVERY = " UNION ALL ".join(t for texts in _RULES.values() for t in texts)
_add("run_suite", "ix_raw products", _EVERY)
_add("run_suite_stored", "ix_raw products", _EVERY)
_add(
    "suite_summary",
    "ix_raw products",
    f"""SELECT dataset, bool_and(status = 'PASS') AS success, count(*) AS evaluated,
               count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed,
               round_even(100.0 * count(*) FILTER (status = 'PASS') / count(*), 1) AS pass_pct
        FROM ({_EVERY}) GROUP BY dataset""",
)

# -- evaluation ----------------------------------------------------------------------------------------
_add("relevance_ground_truth", "ix_clean", "SELECT * FROM truth", *_EVALUATION)
for _metric in ("precision", "recall", "ndcg"):
    _add(
        f"{_metric}_at_k",
        "ix_clean",
        f"SELECT user_id, round_even({_metric}, 6) AS {_metric} FROM scores",
        *_EVALUATION,
    )
_add(
    "evaluate_recommendations",
    "ix_clean",
    f"""SELECT round_even({_mean('precision', 1_000_000_000)}, 4) AS precision_at_10,
               round_even({_mean('recall', 1_000_000_000)}, 4) AS recall_at_10,
               round_even({_mean('ndcg', 1_000_000_000)}, 4) AS ndcg_at_10,
               count(*) AS evaluated_users FROM scores""",
    *_EVALUATION,
)

_add("svd_reconstruction", "ix_clean", "SELECT user_id, item_id, round_even(rating, 6) AS rating FROM ix_clean")

# -- factors ------------------------------------------------------------------------------------------
# Eigenvectors of the item Gramian, largest first: squaring it 22 times leaves the projection on the leading
# one, which is then taken out of the Gramian. Components without weight are zero vectors.
def _powered(matrix: str) -> str:
    """A query of (c, m, top, q): q is the matrix squared again and again, each time divided by its squared length."""
    text = f"SELECT c, m, top, m AS q {matrix}"
    for _ in range(22):
        text = f"""SELECT c, m, top, list_transform(q, lambda r: list_transform(q, lambda s: list_dot_product(r, s) / size)) AS q
            FROM (SELECT *, greatest(list_sum(list_transform(q, lambda t: list_dot_product(t, t))), 1e-300) AS size FROM ({text}))"""
    return text


def _factors(source: str, components: int) -> list[str]:
    """CTEs: `cells`, `its` (item, its place), `eig` (component, value, vector), `u` and `v` (user and item factors)."""
    return [
        f"""cells AS MATERIALIZED (SELECT user_id, item_id, sum(rating) AS r FROM {source} WHERE user_id IS NOT NULL AND item_id IS NOT NULL
            AND rating IS NOT NULL GROUP BY user_id, item_id)""",
        "its AS MATERIALIZED (SELECT item_id, row_number() OVER (ORDER BY item_id) AS j FROM (SELECT DISTINCT item_id FROM cells))",
        "gram AS MATERIALIZED (SELECT a.item_id AS x, b.item_id AS y, sum(a.r * b.r) AS g FROM cells a JOIN cells b USING (user_id) GROUP BY ALL)",
        """gram_rows AS MATERIALIZED (
            SELECT x.j, list(coalesce(g, 0)::DOUBLE ORDER BY y.j) AS r
            FROM its x CROSS JOIN its y LEFT JOIN gram ON gram.x = x.item_id AND gram.y = y.item_id GROUP BY x.j)""",
        "start AS MATERIALIZED (SELECT list(r ORDER BY j) AS m, list_max(list(r[j])) AS top FROM gram_rows)",
        f"""eig AS (
            SELECT 0 AS c, m, top, 0::DOUBLE AS value, []::DOUBLE[] AS vector FROM start
            UNION ALL
            SELECT c + 1, list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1),
                     lambda k: m[i][k] - value * vector[i] * vector[k])), top, value, vector
            FROM (
              SELECT c, m, top, CASE WHEN weight > 1e-9 * top THEN weight ELSE 0 END AS value,
                     CASE WHEN weight > 1e-9 * top THEN vector ELSE list_transform(vector, lambda x: 0::DOUBLE) END AS vector
              FROM (
                SELECT *, list_dot_product(list_transform(m, lambda r: list_dot_product(r, vector)), vector) AS weight
                FROM (
                  SELECT c, m, top, list_transform(col, lambda x: x / greatest(sqrt(list_dot_product(col, col)), 1e-300)) AS vector
                  FROM (
                    SELECT c, m, top, q[list_position(list_transform(range(1, len(q) + 1), lambda i: q[i][i]),
                             list_max(list_transform(range(1, len(q) + 1), lambda i: q[i][i])))] AS col
                    FROM (
                      {_powered(f"FROM eig WHERE c < least({components}, len(m))")})))))""" + ")",
        "v AS MATERIALIZED (SELECT item_id, c, vector[j] AS x FROM eig, its WHERE c > 0)",
        "u AS MATERIALIZED (SELECT user_id, c, sum(r * x) AS x FROM cells JOIN v USING (item_id) GROUP BY user_id, c)",
    ]


_EXPLAINED = """(SELECT sum(s) FROM (SELECT var_pop(x) AS s FROM u GROUP BY c))
    / (SELECT sum(q / n - (s / n) * (s / n)) FROM (SELECT sum(r) AS s, sum(r * r) AS q FROM cells GROUP BY item_id),
         (SELECT count(DISTINCT user_id) AS n FROM cells))"""


def _recommended(users: str, seen: str) -> str:
    return f"""best AS (
        SELECT user_id, item_id, round_even(score, 6) + 0 AS score,
               row_number() OVER (PARTITION BY user_id ORDER BY round_even(score, 6) + 0 DESC, item_id) AS rank
        FROM (SELECT user_id, item_id, sum(u.x * v.x) AS score FROM u JOIN v USING (c) GROUP BY user_id, item_id) p
        WHERE user_id IN (SELECT user_id FROM {users}) AND NOT EXISTS (
          SELECT 1 FROM {seen} t WHERE t.user_id = p.user_id AND t.item_id = p.item_id AND t.rating > 0)
        QUALIFY rank <= 10)"""


def _add_factors(name: str, select: str, *ctes: str) -> None:
    _add(name, "ix_clean", select, *ctes)
    ORACLES[name] = ORACLES[name].replace("WITH ", "WITH RECURSIVE ", 1)


_add_factors(
    "truncated_svd",
    "SELECT (c - 1)::INT AS component, round_even(sqrt(sum(x * x)), 6) AS singular_value FROM u GROUP BY c",
    *_factors("ix_clean", 50),
)
_add_factors("explained_variance", f"SELECT round_even({_EXPLAINED}, 6) AS explained_variance", *_factors("ix_clean", 50))
_add_factors("recommend_top_k", "SELECT * FROM best", *_factors("ix_clean", 50), _recommended("cells", "ix_clean"))
_EVALUATED = [c.replace("JOIN recs r", "JOIN best r") for c in _EVALUATION if not c.startswith(("pool", "recs"))]
_add_factors(
    "train_svd_model",
    f"""SELECT round_even(coalesce({_mean('precision', 1_000_000_000)}, 0), 4) AS precision_at_10,
               round_even(coalesce({_mean('recall', 1_000_000_000)}, 0), 4) AS recall_at_10,
               round_even(coalesce({_mean('ndcg', 1_000_000_000)}, 0), 4) AS ndcg_at_10,
               count(*) AS evaluated_users, round_even({_EXPLAINED}, 4) AS explained_variance,
               (SELECT round_even(1 - count(*)::DOUBLE / (count(DISTINCT user_id) * count(DISTINCT item_id)::DOUBLE), 4) FROM parts) AS sparsity,
               (SELECT count(DISTINCT user_id) FROM parts) AS n_users, (SELECT count(DISTINCT user_id) FROM train) AS train_users,
               (SELECT count(DISTINCT user_id) FROM test) AS test_users, (SELECT count(*) FROM train) AS train_rows,
               (SELECT count(*) FROM test) AS test_rows, (SELECT count(DISTINCT item_id) FROM parts) AS n_items
        FROM scores""",
    *[c.replace(" AS (", " AS MATERIALIZED (", 1) for c in _EVALUATED[:3]],
    *_factors("train", 50),
    _recommended("test", "train"),
    *_EVALUATED[3:],
)

# -- content similarity ----------------------------------------------------------------------------------
_CONTENT = ["price_normalized", "category_encoded", "popularity_score", "avg_rating_received", "total_interactions"]
_NORM = "sqrt(" + " + ".join(f"{c} * {c}" for c in _CONTENT) + ")"
_DOT = " + ".join(f"a.{c} * b.{c}" for c in _CONTENT)
_SIMILAR = [
    *_item_features("ix_orders"),
    "filled AS (SELECT item_id, "
    + ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in _CONTENT)
    + " FROM item_feats)",
    "unit AS (SELECT item_id, "
    + ", ".join(f"coalesce({c} / nullif({_NORM}, 0), 0) AS {c}" for c in _CONTENT)
    + " FROM filled)",
    f"""near AS (
        SELECT a.item_id, b.item_id AS similar_id, round_even({_DOT}, 6) AS similarity,
               row_number() OVER (PARTITION BY a.item_id
                                  ORDER BY round_even({_DOT}, 6) DESC, b.item_id) AS rank
        FROM unit a JOIN unit b ON a.item_id <> b.item_id QUALIFY rank <= 10)""",
]
_add("item_similarity_top_n", "ix_orders products_encoded", "SELECT * FROM near", *_SIMILAR)
_CONSISTENCY = """SELECT round_even(coalesce(avg(share), 0), 4) AS category_consistency,
       count(*) AS items_checked {extra} FROM (
         SELECT n.item_id, avg(CASE WHEN m.category = s.category THEN 1.0 ELSE 0.0 END) AS share
         FROM near n JOIN item_feats m ON n.item_id = m.item_id JOIN item_feats s ON n.similar_id = s.item_id
         WHERE n.rank <= 5
         GROUP BY n.item_id)"""
_add("category_consistency", "ix_orders products_encoded", _CONSISTENCY.format(extra=""), *_SIMILAR)
_add(
    "train_content_model",
    "ix_orders products_encoded",
    _CONSISTENCY.format(extra=", (SELECT count(*) FROM item_feats) AS n_items"),
    *_SIMILAR,
)
_SPARSITY = """count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
    count(*) AS n_interactions,
    1 - CAST(count(*) AS DOUBLE) / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT item_id)) AS sparsity"""
_add(
    "interaction_sparsity",
    "ix_orders",
    f"SELECT * REPLACE (round_even(sparsity, 6) AS sparsity) FROM (SELECT {_SPARSITY} FROM ix_orders)",
)

# -- exploration --------------------------------------------------------------------------------------------


def _activity(source: str) -> str:
    return f"SELECT user_id, count(item_id) AS n FROM {source} GROUP BY user_id"


def _activity_stats(source: str) -> str:
    return f"""SELECT min(n) AS min, max(n) AS max, round_even(avg(n), 2) AS mean,
                      round_even(median(n), 2) AS median FROM ({_activity(source)})"""


_add("rating_distribution", "ix_orders", "SELECT rating, count(*) AS count FROM ix_orders GROUP BY rating")
_add("user_activity_stats", "ix_orders", _activity_stats("ix_orders"))
_add(
    "event_type_distribution",
    "ix_orders",
    """SELECT event_type, count(*) AS count,
              round_even(count(*) * 100.0 / (SELECT count(*) FROM ix_orders), 1) AS pct
       FROM ix_orders GROUP BY event_type""",
)
_add(
    "category_distribution",
    "products",
    "SELECT category, count(*) AS count FROM products WHERE category IS NOT NULL GROUP BY category",
)
_add(
    "eda_summary",
    "ix_clean products_encoded",
    f"""SELECT 'totals' AS section, 'n_users' AS key, CAST(n_users AS DOUBLE) AS value FROM s
        UNION ALL SELECT 'totals', 'n_items', n_items FROM s
        UNION ALL SELECT 'totals', 'n_interactions', n_interactions FROM s
        UNION ALL SELECT 'totals', 'sparsity_pct', round_even(sparsity * 100, 2) FROM s
        UNION ALL SELECT 'totals', 'avg_rating', round_even({_mean('rating')}, 3) FROM ix_clean
        UNION ALL SELECT 'totals', 'rating_std', round_even(stddev_samp(rating), 3) FROM ix_clean
        UNION ALL SELECT 'rating_distribution', CAST(rating AS VARCHAR), count(*) FROM ix_clean GROUP BY rating
        UNION ALL SELECT * FROM (
            SELECT 'top_10_items', CAST(item_id AS VARCHAR), count(*) FROM ix_clean
            GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 10)
        UNION ALL SELECT 'user_activity', 'min', min FROM a
        UNION ALL SELECT 'user_activity', 'max', max FROM a
        UNION ALL SELECT 'user_activity', 'mean', mean FROM a
        UNION ALL SELECT 'user_activity', 'median', median FROM a
        UNION ALL SELECT 'event_types', event_type, count(*) FROM ix_clean GROUP BY event_type
        UNION ALL SELECT 'product_categories', category, count(*) FROM products_encoded GROUP BY category""",
    f"s AS (SELECT {_SPARSITY} FROM ix_clean)",
    f"a AS ({_activity_stats('ix_clean')})",
)
_EDGES = [0.95, 1.45, 1.95, 2.45, 2.95, 3.45, 3.95, 4.45, 4.95, 5.05]
_add(
    "rating_histogram",
    "ix_orders",
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS bin, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high,
            count(*) FILTER (rating >= {low}::DOUBLE AND rating {'<=' if i == 8 else '<'} {high}::DOUBLE) AS count
            FROM ix_orders"""
        for i, (low, high) in enumerate(zip(_EDGES, _EDGES[1:]))
    ),
)
_add(
    "activity_histogram",
    "ix_orders",
    """SELECT bin, round_even(lo + bin * w, 6) AS low, count(*) AS users FROM (
         SELECT least(CAST(floor((n - lo) / w) AS BIGINT), 29) AS bin, lo, w
         FROM a CROSS JOIN (SELECT CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) - min(n) AS DOUBLE) / 30 AS w FROM a))
       GROUP BY bin, lo, w""",
    f"a AS ({_activity('ix_orders')})",
)
_add(
    "price_box_stats",
    "products",
    """SELECT p.category, round_even(any_value(q1), 4) AS q1, round_even(any_value(med), 4) AS median,
              round_even(any_value(q3), 4) AS q3,
              min(price) FILTER (price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
              max(price) FILTER (price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
              count(*) FILTER (price NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
       FROM products p JOIN (
           SELECT category, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS med,
                  quantile_cont(price, 0.75) AS q3
           FROM products WHERE category IS NOT NULL GROUP BY category) b ON p.category = b.category
       WHERE price IS NOT NULL GROUP BY p.category""",
)
_CELLS = f"""cells AS (
    SELECT user_id, item_id, round_even({_mean('rating')}, 4) AS rating FROM ix_orders
    WHERE user_id IN (SELECT user_id FROM ix_orders GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 50)
      AND item_id IN (SELECT item_id FROM ix_orders GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 80)
    GROUP BY user_id, item_id)"""
_add("active_submatrix", "ix_orders", "SELECT * FROM cells", _CELLS)
_add(
    "submatrix_pivot",
    "ix_orders",
    "SELECT user_id, "
    + ", ".join(f"""coalesce(round_even({_mean(f'(CASE WHEN item_id = {i} THEN rating END)')}, 4), 0) AS "{i}" """ for i in range(1, 41))
    + """ FROM ix_orders WHERE item_id BETWEEN 1 AND 40
         AND user_id IN (SELECT user_id FROM ix_orders GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 50) GROUP BY user_id""",
)
_add(
    "submatrix_sparsity",
    "ix_orders",
    "SELECT count(*) AS filled, round_even(1 - count(*) / CAST(50 * 80 AS DOUBLE), 4) AS sparsity FROM cells",
    _CELLS,
)
_add(
    "day_hour_density",
    "ix_events",
    "SELECT CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week, dayname(timestamp) AS day, "
    + ", ".join(f"count(*) FILTER (hour(timestamp) = {h}) AS h{h:02d}" for h in range(24))
    + " FROM ix_events GROUP BY 1, 2",
)

# -- feature store and runs --------------------------------------------------------------------------------
_USER_COLUMNS = (
    "user_id,total_interactions,unique_items,avg_rating_given,std_rating_given,purchase_count,"
    "view_count,wishlist_count,cart_count,activity_score,recency_days,created_at"
)
_add(
    "fs_write",
    "ix_events ix_clean ix_orders",
    f"""SELECT 'user_features' AS name, 'v1' AS version, 'user_id' AS entity, 'events' AS source,
               count(DISTINCT user_id) AS rows, CAST(12 AS BIGINT) AS cols, '{_USER_COLUMNS}' AS columns FROM ix_events
        UNION ALL SELECT 'user_features', 'v2', 'user_id', 'events', count(DISTINCT user_id), 12, '{_USER_COLUMNS}'
        FROM ix_clean
        UNION ALL SELECT 'item_activity', 'v1', 'item_id', 'lineitem', count(DISTINCT item_id), 3,
               'item_id,total_interactions,unique_users' FROM ix_orders""",
)
_add(
    "fs_read",
    "ix_clean",
    f"SELECT user_id, activity_score, avg_rating_given FROM ({_USER_FEATURES.format(source='ix_clean')})",
)
_add(
    "fs_read_version",
    "ix_events",
    """SELECT user_id, count(item_id) AS total_interactions, count(DISTINCT item_id) AS unique_items
       FROM ix_events GROUP BY user_id""",
)
_add(
    "fs_get_version",
    "ix_events",
    """SELECT 'user_features' AS name, 'v1' AS version, 'raw' AS description, count(DISTINCT user_id) AS rows,
              CAST(12 AS BIGINT) AS cols FROM ix_events""",
)
_add(
    "fs_list_groups",
    "ix_clean ix_orders",
    """SELECT 'user_features' AS name WHERE EXISTS (SELECT 1 FROM ix_clean)
       UNION ALL SELECT 'item_activity' WHERE EXISTS (SELECT 1 FROM ix_orders)""",
)
_add(
    "fs_lookup_ids",
    "ix_clean",
    f"""SELECT * FROM ({_USER_FEATURES.format(source='ix_clean')})
        WHERE user_id = (SELECT min(user_id) FROM events) OR user_id = (SELECT max(user_id) FROM events)""",
)
_add(
    "fs_online_lookup",
    "ix_clean",
    f"""SELECT * FROM ({_USER_FEATURES.format(source='ix_clean')})
        WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'error')""",
)
_add(
    "fs_list_versions",
    "ix_clean",
    """SELECT 'v1' AS version, CAST(1 AS BIGINT) AS position WHERE EXISTS (SELECT 1 FROM events)
       UNION ALL SELECT 'v2', 2 WHERE EXISTS (SELECT 1 FROM ix_clean)""",
)
_add(
    "fs_registry",
    "ix_clean ix_orders",
    """SELECT 'user_features' AS name, 'v2' AS version, count(DISTINCT user_id) AS rows FROM ix_clean
       UNION ALL SELECT 'item_activity', 'v1', count(DISTINCT item_id) FROM ix_orders""",
)
_add(
    "infer_feature_defs",
    "ix_orders",
    """SELECT c AS feature, 'bigint' AS dtype, c AS description, count(DISTINCT item_id) AS values
       FROM ix_orders, (VALUES ('item_id'), ('total_interactions'), ('unique_users')) f(c) GROUP BY c""",
)
_CATALOG = {
    ("user_features", "user_id"): "total_interactions:int unique_items:int avg_rating_given:float"
    " std_rating_given:float purchase_count:int view_count:int activity_score:float recency_days:float",
    ("item_features", "item_id"): "total_interactions:int unique_users:int avg_rating_received:float"
    " popularity_score:float price_normalized:float category_encoded:int",
    ("interaction_features", "user_id+item_id"): "rating:float hour_of_day:int day_of_week:int"
    " is_weekend:int user_item_gap:float",
}
ORACLES["feature_catalog"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{group}', '{entity}', '{pair.split(':')[0]}', '{pair.split(':')[1]}')"
    for (group, entity), pairs in _CATALOG.items()
    for pair in pairs.split()
) + ") t(feature_group, entity, feature, dtype)"
_RUN_METRICS = " UNION ALL ".join(
    f"""SELECT 'sparsity' AS experiment, 'FINISHED' AS status, '{label}' AS view, metric,
               CAST(value AS DOUBLE) AS value FROM (
          SELECT count(DISTINCT user_id)::DOUBLE AS n_users, count(DISTINCT item_id)::DOUBLE AS n_items,
                 round_even(1 - CAST(count(*) AS DOUBLE)
                   / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT item_id)), 6) AS sparsity
          FROM {view}) UNPIVOT (value FOR metric IN (n_users, n_items, sparsity))"""
    for label, view in (("events", "ix_events"), ("orders", "ix_orders"), ("clean", "ix_clean"))
)
_add("log_run", "ix_events ix_orders ix_clean", _RUN_METRICS)
_add(
    "compare_runs",
    "ix_events ix_orders ix_clean",
    """SELECT experiment, metric, count(*) AS runs, max(value) FILTER (view = 'clean') AS latest_value,
              max(value) AS best_value FROM m GROUP BY experiment, metric""",
    f"m AS ({_RUN_METRICS})",
)
_add(
    "end_to_end_row_counts",
    "ix_clean products_encoded",
    """SELECT 'interactions_raw' AS "table", count(*) AS rows FROM ix_raw
       UNION ALL SELECT 'products_raw', count(*) FROM products
       UNION ALL SELECT 'quality_results', 22
       UNION ALL SELECT 'interactions_clean', count(*) FROM ix_clean
       UNION ALL SELECT 'products_encoded', count(*) FROM products_encoded
       UNION ALL SELECT 'user_features', count(DISTINCT user_id) FROM ix_clean
       UNION ALL SELECT 'item_features', count(DISTINCT item_id) FROM ix_clean
       UNION ALL SELECT 'interaction_features', count(*) FROM ix_clean
       UNION ALL SELECT 'item_cooccurrence', count(*) FROM pairs
       UNION ALL SELECT 'feature_registry', 3
       UNION ALL SELECT 'experiment_runs', 2""",
    *_pairs("ix_clean")[:3],
)
