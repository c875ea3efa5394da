"""Interaction and catalog views over the given tables, in Spark and as SQL text.

Every view keeps all rows of its tables. `ix_raw` carries deliberate dirt (missing users, missing and
unreadable times, missing ratings) so that cleaning has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinis.operators.encode import encode_products
from affinis.operators.prepare import clean_interactions, clean_products
from affinis.session import pin

AS_OF = "2025-01-01 00:00:00"
ORDER_KEYS = ["timestamp", "ord", "line", "item_id", "rating", "event_type"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_EVENT_TYPE = (
    "CASE event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'wishlist' ELSE event_type END"
    " AS event_type"
)
_RATING = "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(0.5 AS DOUBLE) + value / 20 END AS rating"


def ix_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "user_id",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS item_id",
        _RATING,
        "CAST(ts AS TIMESTAMP) AS timestamp",
        _EVENT_TYPE,
        "event_id AS seq",
    )


def ix_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS item_id",
        _RATING,
        "CASE WHEN event_id % 211 = 0 THEN 'not a date' WHEN event_id % 223 = 0 THEN NULL"
        " ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS timestamp",
        _EVENT_TYPE,
        "event_id AS seq",
    )


def ix_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
        "o_custkey AS user_id",
        "l_partkey AS item_id",
        "l_quantity / 10 AS rating",
        "CAST(l_shipdate AS TIMESTAMP) AS timestamp",
        "CASE WHEN l_returnflag = 'A' THEN 'purchase' WHEN l_returnflag = 'N' THEN 'view'"
        " WHEN l_linestatus = 'F' THEN 'wishlist' ELSE 'cart' END AS event_type",
        "l_orderkey AS ord",
        "l_linenumber AS line",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS item_id",
        "p_name AS title",
        "CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE lower(p_type) END AS category",
        "p_brand AS brand",
        "CASE WHEN p_partkey % 100 = 0 THEN -p_retailprice ELSE p_retailprice END AS price",
        "CAST(p_size AS DOUBLE) / 8 AS rating",
        "p_size * 10 AS rating_count",
        "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size % 7 <> 0 END AS in_stock",
    )


def ix_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_interactions(ix_raw(spark, sf_dir), tiebreak=["seq"])


def products_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_products(pin(clean_products(products(spark, sf_dir))))[0]


_SQL_EVENT_TYPE = _EVENT_TYPE
VIEW_SQL = {
    "ix_events": f"""
        SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, {_RATING},
               ts AS timestamp, {_SQL_EVENT_TYPE}, event_id AS seq
        FROM events""",
    "ix_raw": f"""
        SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, {_RATING},
               CASE WHEN event_id % 211 = 0 THEN 'not a date' WHEN event_id % 223 = 0 THEN NULL
                    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp,
               {_SQL_EVENT_TYPE}, event_id AS seq
        FROM events""",
    "ix_orders": """
        SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, l.l_quantity / 10 AS rating,
               l.l_shipdate AS timestamp,
               CASE WHEN l.l_returnflag = 'A' THEN 'purchase' WHEN l.l_returnflag = 'N' THEN 'view'
                    WHEN l.l_linestatus = 'F' THEN 'wishlist' ELSE 'cart' END AS event_type,
               l.l_orderkey AS ord, l.l_linenumber AS line
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "products": """
        SELECT p_partkey AS item_id, p_name AS title,
               CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE lower(p_type) END AS category,
               p_brand AS brand,
               CASE WHEN p_partkey % 100 = 0 THEN -p_retailprice ELSE p_retailprice END AS price,
               CAST(p_size AS DOUBLE) / 8 AS rating, p_size * 10 AS rating_count,
               CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size % 7 <> 0 END AS in_stock
        FROM part""",
    "ix_keyed": "SELECT * FROM ix_raw WHERE user_id IS NOT NULL AND item_id IS NOT NULL",
    "ix_user_median": "SELECT user_id, median(rating) AS m FROM ix_keyed GROUP BY user_id",
    "ix_user_filled": """
        SELECT k.user_id, k.item_id, coalesce(k.rating, u.m) AS rating, k.timestamp, k.event_type, k.seq
        FROM ix_keyed k LEFT JOIN ix_user_median u ON k.user_id = u.user_id""",
    "ix_filled": """
        SELECT user_id, item_id,
               coalesce(rating, (SELECT median(rating) FROM ix_user_filled)) AS rating,
               timestamp, event_type, seq
        FROM ix_user_filled""",
    "ix_clipped": """
        SELECT user_id, item_id,
               CASE WHEN rating < 1 THEN CAST(1 AS DOUBLE) WHEN rating > 5 THEN CAST(5 AS DOUBLE)
                    ELSE rating END AS rating, timestamp, event_type, seq
        FROM ix_filled""",
    "ix_latest": """
        SELECT * FROM ix_clipped QUALIFY row_number() OVER (
            PARTITION BY user_id, item_id ORDER BY timestamp DESC NULLS FIRST, seq DESC) = 1""",
    "ix_clean": """
        SELECT user_id, item_id, round_even(rating, 1) AS rating,
               TRY_CAST(timestamp AS TIMESTAMP) AS timestamp, event_type, seq
        FROM ix_latest WHERE TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL""",
    "products_clean": """
        SELECT item_id, title, coalesce(category, 'unknown') AS category, brand,
               CASE WHEN price <= 0 THEN (SELECT median(price) FROM products WHERE price > 0)
                    ELSE price END AS price,
               CASE WHEN rating < 0 THEN CAST(0 AS DOUBLE) WHEN rating > 5 THEN CAST(5 AS DOUBLE)
                    ELSE rating END AS rating,
               rating_count, coalesce(in_stock, true) AS in_stock
        FROM products""",
    "products_encoded": """
        SELECT *, CAST(dense_rank() OVER (ORDER BY category) - 1 AS BIGINT) AS category_encoded,
               CAST(dense_rank() OVER (ORDER BY coalesce(brand, 'nan')) - 1 AS BIGINT) AS brand_encoded,
               (price - (SELECT min(price) FROM products_clean))
               / ((SELECT max(price) FROM products_clean) - (SELECT min(price) FROM products_clean))
               AS price_normalized
        FROM products_clean""",
}
_NEEDS = {
    "ix_keyed": ["ix_raw"],
    "ix_user_median": ["ix_keyed"],
    "ix_user_filled": ["ix_keyed", "ix_user_median"],
    "ix_filled": ["ix_user_filled"],
    "ix_clipped": ["ix_filled"],
    "ix_latest": ["ix_clipped"],
    "ix_clean": ["ix_latest"],
    "products_clean": ["products"],
    "products_encoded": ["products_clean"],
}


def with_views(names: str, *ctes: str, select: str) -> str:
    """SQL text: the named views and what they need, further CTEs, then the query."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{name} AS ({VIEW_SQL[name]})" for name in ordered] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + select
