"""Table schemas. The column names and types below are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- fixed values: logical tables -------------------------------------------
INTERACTIONS_RAW = _schema(
    "user_id BIGINT, item_id BIGINT, rating DOUBLE, timestamp STRING, event_type STRING"
)
PRODUCTS_RAW = _schema(
    "item_id BIGINT, title STRING, category STRING, brand STRING, price DOUBLE,"
    " rating DOUBLE, rating_count INT, in_stock BOOLEAN"
)
USER_FEATURES = _schema(
    "user_id BIGINT, total_interactions BIGINT, unique_items BIGINT, avg_rating_given DOUBLE,"
    " std_rating_given DOUBLE, purchase_count BIGINT, view_count BIGINT, wishlist_count BIGINT,"
    " cart_count BIGINT, activity_score BIGINT, recency_days DOUBLE, created_at STRING"
)
ITEM_FEATURES = _schema(
    "item_id BIGINT, total_interactions BIGINT, unique_users BIGINT, avg_rating_received DOUBLE,"
    " std_rating_received DOUBLE, popularity_score DOUBLE, category STRING, price DOUBLE,"
    " price_normalized DOUBLE, brand STRING, category_encoded BIGINT, created_at STRING"
)
INTERACTION_FEATURES = _schema(
    "user_id BIGINT, item_id BIGINT, rating DOUBLE, hour_of_day BIGINT, day_of_week BIGINT,"
    " is_weekend BIGINT, user_item_gap DOUBLE, event_type STRING, timestamp STRING"
)
ITEM_COOCCURRENCE = _schema(
    "item_a BIGINT, item_b BIGINT, cooccur_count BIGINT, jaccard_similarity DOUBLE"
)

# Feature tables with their unique keys.
FEATURE_TABLES = {
    "user_features": (USER_FEATURES, ["user_id"]),
    "item_features": (ITEM_FEATURES, ["item_id"]),
    "interaction_features": (INTERACTION_FEATURES, ["user_id", "item_id"]),
    "item_cooccurrence": (ITEM_COOCCURRENCE, ["item_a", "item_b"]),
}

REQUIRED_INTERACTION_COLUMNS = ["user_id", "item_id", "rating", "timestamp"]
EVENT_TYPES = ["purchase", "view", "wishlist", "cart"]
PRODUCT_CATEGORIES = ["electronics", "clothing", "home", "books", "sports", "beauty"]
# --- end of fixed values ------------------------------------------------------
