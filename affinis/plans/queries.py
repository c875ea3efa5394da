"""The registered queries: each operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.functions.columns import half_even, time_text
from affinis.operators import (
    cooccurrence,
    dedup,
    eda,
    encode,
    evaluate,
    features,
    joins,
    prepare,
    quality,
    recommend,
    split,
    svd,
)
from affinis.plans.full_run import row_counts, run_all
from affinis.plans.views import (
    AS_OF,
    ORDER_KEYS,
    ix_clean,
    ix_events,
    ix_orders,
    ix_raw,
    products,
    products_encoded,
    table,
)
from affinis.schemas import INTERACTIONS_RAW
from affinis.session import pin, scratch_dir
from affinis.sources import checks, readers, runs, writers
from affinis.sources.feature_store import FEATURE_DEFS, GROUP_ENTITIES, FeatureStore, infer_feature_defs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOP_K, COMPONENTS = 10, 50
HEAD = 1000
STRICT_TIME = {"rule": "strftime_format", "column": "timestamp", "format": "%Y-%m-%d %H:%M:%S"}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def _text_time(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", time_text(F.col("timestamp")))


# -- sources and sinks -----------------------------------------------------------------


@query
def scan_interactions(spark, sf):
    path = scratch_dir(spark, "landed")
    ix_raw(spark, sf).write.option("header", True).csv(path)
    schema = T.StructType([*INTERACTIONS_RAW.fields, T.StructField("seq", T.LongType())])
    return readers.accepted(readers.scan_interactions(spark, path, schema))


def _landed_csv(spark, sf):
    """The raw interactions as CSV files of three shapes: all columns in order, reordered without the event type and with
    ids written as decimals, and lines that do not fit."""
    path, raw = scratch_dir(spark, "landed"), ix_raw(spark, sf)
    schema = T.StructType([*INTERACTIONS_RAW.fields, T.StructField("seq", T.LongType())])
    kind = F.col("seq") % 3
    raw.filter(kind == 0).write.option("header", True).csv(f"{path}/a")
    decimals = [F.concat(F.col(c).cast("string"), F.lit(".0")).alias(c) for c in ("item_id", "user_id")]
    raw.filter(kind == 1).select("seq", "rating", "timestamp", *decimals).write.option("header", True).csv(f"{path}/b")
    broken = F.when(F.col("seq") % 2 == 0, F.lit("many")).otherwise(F.concat(F.col("rating").cast("string"), F.lit("x")))
    odd = raw.filter(kind == 2).select("user_id", "item_id", broken.alias("rating"), "timestamp", "event_type", "seq")
    odd.write.option("header", True).csv(f"{path}/c")
    return readers.scan_interactions(spark, f"{path}/*", schema)


@query
def scan_interactions_by_header(spark, sf):
    return readers.accepted(_landed_csv(spark, sf))


@query
def reject_counts(spark, sf):
    return readers.reject_counts(_landed_csv(spark, sf))


@query
def scan_products_json(spark, sf):
    """Half of the records land in the nested shape, half in the flat one."""
    nested = F.to_json(
        F.struct(
            F.col("item_id").alias("id"), "title", "price", "category",
            F.struct(F.col("rating").alias("rate"), F.col("rating_count").alias("count")).alias("rating"),
        )
    )
    flat = F.to_json(F.struct("item_id", "title", "category", "brand", "price", "rating", "rating_count", "in_stock"))
    path = scratch_dir(spark, "landed")
    shaped = F.when(F.col("item_id") % 2 == 0, nested).otherwise(flat)
    products(spark, sf).select(shaped.alias("value")).write.text(path)
    return readers.scan_products_json(spark, path)


@query
def scan_latest_snapshot(spark, sf):
    path = scratch_dir(spark, "snapshots")
    catalog = products(spark, sf)
    writers.write_raw_snapshot(catalog, path, "parquet", "s1")
    writers.write_raw_snapshot(catalog.withColumn("price", F.col("price") * 2), path, "parquet", "s2")
    return readers.scan_latest_snapshot(spark, path)


@query
def write_raw_snapshot(spark, sf):
    path = scratch_dir(spark, "raw")
    writers.write_raw_snapshot(ix_raw(spark, sf), path, "csv", "s1")
    schema = "user_id BIGINT, item_id BIGINT, rating DOUBLE, timestamp STRING, event_type STRING, seq BIGINT, ingest_ts STRING"
    return spark.read.schema(schema).option("header", True).csv(path)


@query
def write_processed_snapshot(spark, sf):
    root = scratch_dir(spark, "processed")
    writers.write_processed_snapshot(ix_clean(spark, sf), root, "interactions_clean", "s1")
    return _text_time(readers.scan_latest_snapshot(spark, f"{root}/interactions_clean"))


def _feature_tables(spark, sf) -> dict[str, DataFrame]:
    clean = pin(ix_clean(spark, sf))
    return {
        "user_features": features.user_features(clean, AS_OF),
        "item_features": features.item_features(clean, products_encoded(spark, sf), AS_OF),
        "interaction_features": features.interaction_features(clean, ["seq"]),
        "item_cooccurrence": cooccurrence.item_jaccard(clean),
    }


@query
def write_feature_tables(spark, sf):
    """Rows and sums of the four tables as read back."""
    root = scratch_dir(spark, "features")
    tables = _feature_tables(spark, sf)
    writers.write_feature_tables(tables, root)
    sums = {
        "user_features": "total_interactions",
        "item_features": "total_interactions",
        "interaction_features": "item_id",
        "item_cooccurrence": "cooccur_count",
    }
    out = None
    for name, column in sums.items():
        part = readers.read_feature_table(spark, root, name).agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), F.sum(column).alias("total")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def read_feature_table(spark, sf):
    root = scratch_dir(spark, "features")
    table_ = features.user_features(ix_clean(spark, sf), AS_OF)
    writers.write_feature_tables({"user_features": table_}, root)
    return readers.read_feature_table(spark, root, "user_features")


@query
def require_columns(spark, sf):
    return checks.require_columns(ix_raw(spark, sf), ["user_id", "item_id", "rating", "timestamp", "channel"])


@query
def null_counts(spark, sf):
    return checks.null_counts(ix_raw(spark, sf))


@query
def duplicate_key_count(spark, sf):
    return checks.duplicate_key_count(ix_orders(spark, sf))


@query
def table_checksum(spark, sf):
    return checks.table_checksum(_text_time(ix_orders(spark, sf)), "md5")


@query
def table_checksum_md5(spark, sf):
    """The same form over a table with nulls."""
    return checks.table_checksum(_text_time(ix_events(spark, sf)), "md5")


@query
def table_checksum_hash64(spark, sf):
    return checks.table_checksum(ix_orders(spark, sf))


# -- cleaning ------------------------------------------------------------------------------


@query
def drop_null_keys(spark, sf):
    return prepare.drop_null_keys(ix_raw(spark, sf))


@query
def impute_group_median(spark, sf):
    filled = prepare.impute_group_median(prepare.drop_null_keys(ix_raw(spark, sf)))
    return filled.withColumn("rating", F.round("rating", 6))


@query
def clip_range(spark, sf):
    return prepare.clip_range(ix_events(spark, sf), "rating", 1.0, 5.0).drop("timestamp")


@query
def count_clipped(spark, sf):
    return prepare.count_clipped(ix_events(spark, sf), "rating", 1.0, 5.0)


@query
def normalize_types(spark, sf):
    return _text_time(prepare.normalize_types(ix_events(spark, sf)))


@query
def parse_timestamps(spark, sf):
    return _text_time(prepare.parse_timestamps(ix_raw(spark, sf)))


@query
def count_bad_timestamps(spark, sf):
    return prepare.count_bad_timestamps(ix_raw(spark, sf))


@query
def fill_defaults(spark, sf):
    return prepare.fill_defaults(products(spark, sf))


@query
def repair_nonpositive(spark, sf):
    return prepare.repair_nonpositive(products(spark, sf))


@query
def clean_interactions(spark, sf):
    return _text_time(ix_clean(spark, sf))


@query
def clean_products(spark, sf):
    return prepare.clean_products(products(spark, sf))


@query
def dedup_keep_latest(spark, sf):
    return dedup.dedup_keep_latest(ix_raw(spark, sf), tiebreak=["seq"])


@query
def dedup_keep_latest_parsed(spark, sf):
    return dedup.dedup_keep_latest(ix_raw(spark, sf), tiebreak=["seq"], parse_first=True)


@query
def dedup_keep_first(spark, sf):
    return _text_time(dedup.dedup_keep_first(ix_orders(spark, sf), ["user_id", "item_id"], ORDER_KEYS))


@query
def label_encode(spark, sf):
    catalog = products(spark, sf)
    return encode.label_encode(encode.label_encode(catalog, "category"), "brand")


@query
def min_max_scale(spark, sf):
    return encode.min_max_scale(products(spark, sf)).select("item_id", "price", "price_normalized")


@query
def encode_products(spark, sf):
    return products_encoded(spark, sf)


@query
def transform_products(spark, sf):
    """Encoders fitted to items with even ids, applied to the whole catalog."""
    catalog = pin(prepare.clean_products(products(spark, sf)))
    _, encoders = encode.encode_products(pin(catalog.filter("item_id % 2 = 0")))
    found = encode.transform_products(catalog, encoders)
    return found.select("item_id", "category_encoded", F.round("price_normalized", 9).alias("price_normalized"))


# -- features --------------------------------------------------------------------------------


@query
def user_activity_agg(spark, sf):
    found = features.user_activity_agg(ix_clean(spark, sf))
    return found.select(
        "user_id", "total_interactions", "unique_items",
        half_even(F.col("avg_rating_given"), 6).alias("avg_rating_given"),
        half_even(F.col("std_rating_given"), 6).alias("std_rating_given"),
        time_text(F.col("last_interaction")).alias("last_interaction"),
    )


@query
def event_type_counts(spark, sf):
    return features.event_type_counts(ix_orders(spark, sf))


@query
def activity_score(spark, sf):
    counts = features.event_type_counts(ix_orders(spark, sf))
    return counts.select("user_id", features.activity_score().alias("activity_score"))


@query
def recency_days(spark, sf):
    last = ix_events(spark, sf).groupBy("user_id").agg(F.max("timestamp").alias("last"))
    return last.select("user_id", features.recency_days(F.col("last"), AS_OF).alias("recency_days"))


@query
def user_features(spark, sf):
    return features.user_features(ix_clean(spark, sf), AS_OF)


@query
def item_activity_agg(spark, sf):
    found = features.item_activity_agg(ix_orders(spark, sf))
    return found.select(
        "item_id", "total_interactions", "unique_users",
        half_even(F.col("avg_rating_received"), 6).alias("avg_rating_received"),
        half_even(F.col("std_rating_received"), 6).alias("std_rating_received"),
    )


@query
def popularity_score(spark, sf):
    found = features.popularity_score(features.item_activity_agg(ix_orders(spark, sf)))
    return found.select("item_id", "total_interactions", "popularity_score")


def _order_item_features(spark, sf) -> DataFrame:
    return features.item_features(ix_orders(spark, sf), products_encoded(spark, sf), AS_OF)


@query
def item_features(spark, sf):
    return _order_item_features(spark, sf).withColumn("price_normalized", F.round("price_normalized", 9))


@query
def time_parts(spark, sf):
    return features.time_parts(ix_events(spark, sf)).select("seq", "hour_of_day", "day_of_week", "is_weekend")


@query
def user_rating_gap(spark, sf):
    return features.user_rating_gap(ix_orders(spark, sf)).select("user_id", "item_id", "rating", "ord", "line", "user_item_gap")


@query
def interaction_features(spark, sf):
    return features.interaction_features(pin(ix_clean(spark, sf)), ["seq"])


@query
def item_cooccurrence(spark, sf):
    return cooccurrence.item_cooccurrence(ix_orders(spark, sf))


@query
def item_jaccard(spark, sf):
    return cooccurrence.item_jaccard(ix_orders(spark, sf))


@query
def join_catalog(spark, sf):
    catalog = products(spark, sf).withColumn("price_normalized", F.col("price") / 1000)
    return features.join_catalog(eda._item_counts(ix_orders(spark, sf)), catalog)


@query
def join_event_counts(spark, sf):
    orders = ix_orders(spark, sf)
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return features.join_event_counts(users, orders, "wishlist")


@query
def semi_join_entities(spark, sf):
    """Order lines of the items without a usable price."""
    ids = products(spark, sf).filter("price <= 0").select("item_id")
    return joins.semi_join_entities(ix_orders(spark, sf), "item_id", ids).drop("timestamp")


def _split_events(spark, sf) -> DataFrame:
    return pin(split.temporal_holdout_split(ix_clean(spark, sf), ["timestamp", "seq"]))


def _offered(train: DataFrame, users: DataFrame, head: int = HEAD) -> DataFrame:
    """user_id, item_id, place: the most used items for each user, TOP_K more than the user has rated.

    The first `head` places are one array; later ones go to users with many ratings only and are joined, so the rows grow
    with the ratings and no array is longer than `head`.
    """
    ranked = pin(eda.popularity_rank(train).select("item_id", F.col("rank").alias("place")))
    rated = train.groupBy("user_id").agg(F.count_distinct("item_id").alias("n"))
    asked = users.join(rated, "user_id", "left").select("user_id", (F.coalesce("n", F.lit(0)) + TOP_K).alias("last"))
    pool = ranked.filter(F.col("place") <= head).agg(F.sort_array(F.collect_list(F.struct("place", "item_id"))).alias("pool"))
    own = F.slice(pool.scalar(), F.lit(1), F.least("last", F.lit(head)).cast("int"))
    near = asked.select("user_id", F.explode(own).alias("item")).select("user_id", "item.item_id", "item.place")
    steps = F.sequence(F.lit(1), F.floor((F.col("last") - 1) / head))
    far = asked.filter(F.col("last") > head).select("user_id", "last", F.explode(steps).alias("step"))
    places = F.sequence(F.col("step") * head + 1, F.least("last", (F.col("step") + 1) * head))
    far = far.select("user_id", F.explode(places).alias("place")).join(ranked, "place")
    return near.unionByName(far)


def _popular_unseen(train: DataFrame, users: DataFrame) -> DataFrame:
    """Recommendations any engine can repeat: the most used items the user has not rated.

    A list cannot run out within TOP_K places more than the user has rated, so that many items are offered.
    """
    left = joins.anti_join_seen(_offered(train, users), train)
    rank = F.row_number().over(W.partitionBy("user_id").orderBy("place")).cast("long")
    return left.select("user_id", "item_id", rank.alias("rank")).filter(F.col("rank") <= TOP_K)


def _evaluation(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    parts = _split_events(spark, sf)
    train, test = parts.filter("NOT is_test"), parts.filter("is_test")
    users = test.select("user_id").distinct()
    return _popular_unseen(train, users), evaluate.relevance_ground_truth(test), users


@query
def anti_join_seen(spark, sf):
    return _evaluation(spark, sf)[0]


# -- order, split, top-k ---------------------------------------------------------------------------


@query
def sequence_in_user(spark, sf):
    placed = split.sequence_in_user(ix_orders(spark, sf), ORDER_KEYS)
    return placed.select("user_id", "item_id", "ord", "line", "seq_in_user", "user_total")


@query
def temporal_holdout_split(spark, sf):
    return split.temporal_holdout_split(ix_orders(spark, sf), ORDER_KEYS).drop("timestamp")


@query
def top_items(spark, sf):
    return eda.top_items(ix_orders(spark, sf), 20)


@query
def popularity_rank(spark, sf):
    return eda.popularity_rank(ix_orders(spark, sf))


# -- quality -------------------------------------------------------------------------------------------


def _rules(spark, sf, name: str) -> DataFrame:
    """All rules of one kind from both suites, on both tables."""
    def chosen(suite):
        return [r for r in suite if r["rule"] == name]

    parts = []
    for dataset, df, suite in (
        ("interactions", ix_raw(spark, sf), quality.INTERACTIONS_SUITE),
        ("products", products(spark, sf), quality.PRODUCTS_SUITE),
    ):
        if chosen(suite):
            parts.append(quality.expectation(df, dataset, *chosen(suite)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _rule_query(key: str, rule: str) -> None:
    def run(spark, sf):
        return _rules(spark, sf, rule).drop("position", "kwargs")

    QUERIES[key] = run


for _key, _rule in {
    "expect_row_count_between": "row_count_between",
    "expect_columns_superset": "columns_superset",
    "expect_not_null": "not_null",
    "expect_between": "between",
    "expect_column_min_between": "column_min_between",
    "expect_compound_unique": "compound_unique",
    "expect_unique": "unique",
    "expect_in_set": "in_set",
    "expect_strftime_format": "strftime_format",
}.items():
    _rule_query(_key, _rule)


def _suites(spark, sf) -> DataFrame:
    first = quality.run_suite(ix_raw(spark, sf), "interactions", quality.INTERACTIONS_SUITE)
    return first.unionByName(quality.run_suite(products(spark, sf), "products", quality.PRODUCTS_SUITE))


@query
def run_suite(spark, sf):
    return _suites(spark, sf).drop("kwargs")


@query
def run_suite_stored(spark, sf):
    """Both suites written in the stored form, read back and run."""
    parts = []
    for dataset, suite, frame, may_lack in (
        ("interactions", quality.INTERACTIONS_SUITE, ix_raw(spark, sf), ["event_type"]),
        ("products", quality.PRODUCTS_SUITE, products(spark, sf), []),
    ):
        path = scratch_dir(spark, "suite")
        spark.createDataFrame([(quality.stored_suite(dataset, suite),)], "value STRING").coalesce(1).write.text(path)
        parts.append(quality.run_suite(frame, dataset, quality.load_suite(path, may_lack)))
    return parts[0].unionByName(parts[1]).drop("kwargs")


@query
def suite_summary(spark, sf):
    return quality.suite_summary(_suites(spark, sf))


# -- evaluation -------------------------------------------------------------------------------------------


@query
def relevance_ground_truth(spark, sf):
    return evaluate.relevance_ground_truth(_split_events(spark, sf).filter("is_test"))


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, half_even(F.col(column), 6))


@query
def precision_at_k(spark, sf):
    recommended, truth, _ = _evaluation(spark, sf)
    return _rounded(evaluate.precision_at_k(recommended, truth, TOP_K), "precision")


@query
def recall_at_k(spark, sf):
    recommended, truth, _ = _evaluation(spark, sf)
    return _rounded(evaluate.recall_at_k(recommended, truth, TOP_K), "recall")


@query
def ndcg_at_k(spark, sf):
    recommended, truth, _ = _evaluation(spark, sf)
    return _rounded(evaluate.ndcg_at_k(recommended, truth, TOP_K), "ndcg")


@query
def evaluate_recommendations(spark, sf):
    recommended, truth, users = _evaluation(spark, sf)
    return evaluate.evaluate_recommendations(recommended, truth, users, TOP_K)


# -- recommenders ---------------------------------------------------------------------------------------------


@query
def truncated_svd(spark, sf):
    """Singular values as the lengths of the user factor columns (free of the sign of a factor)."""
    model = svd.truncated_svd(pin(ix_clean(spark, sf)), COMPONENTS)
    return (
        model.user_factors.select(F.posexplode("vector").alias("component", "v"))
        .groupBy("component")
        .agg(half_even(F.sqrt(F.sum(F.col("v") * F.col("v"))), 6).alias("singular_value"))
    )


@query
def svd_reconstruction(spark, sf):
    """With as many components as items the factors give every rating back."""
    clean = pin(ix_clean(spark, sf))
    model = svd.truncated_svd(clean, svd.GRAM_LIMIT)
    users = model.user_factors.withColumnRenamed("vector", "u")
    items = model.item_factors.withColumnRenamed("vector", "v")
    terms = F.zip_with("u", "v", lambda a, b: a * b)
    product = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    return (
        clean.join(users, "user_id").join(items, "item_id").select("user_id", "item_id", half_even(product, 6).alias("rating"))
    )


@query
def explained_variance(spark, sf):
    clean = pin(ix_clean(spark, sf))
    return _rounded(svd.explained_variance(clean, svd.truncated_svd(clean, COMPONENTS)), "explained_variance")


@query
def recommend_top_k(spark, sf):
    clean = pin(ix_clean(spark, sf))
    return recommend.recommend_top_k(svd.truncated_svd(clean, COMPONENTS), seen=clean, n=TOP_K)


@query
def item_similarity_top_n(spark, sf):
    return recommend.item_similarity_top_n(_order_item_features(spark, sf))


@query
def category_consistency(spark, sf):
    return recommend.category_consistency(pin(_order_item_features(spark, sf)))


@query
def interaction_sparsity(spark, sf):
    return _rounded(recommend.interaction_sparsity(ix_orders(spark, sf)), "sparsity")


@query
def train_svd_model(spark, sf):
    return recommend.train_svd(ix_clean(spark, sf), COMPONENTS, TOP_K, ["timestamp", "seq"]).metrics


@query
def train_content_model(spark, sf):
    return recommend.train_content(pin(_order_item_features(spark, sf)))


# -- exploration --------------------------------------------------------------------------------------------------


@query
def eda_summary(spark, sf):
    return eda.eda_summary(pin(ix_clean(spark, sf)), pin(products_encoded(spark, sf)))


@query
def rating_distribution(spark, sf):
    return eda.rating_distribution(ix_orders(spark, sf))


@query
def user_activity_stats(spark, sf):
    return eda.user_activity_stats(ix_orders(spark, sf))


@query
def event_type_distribution(spark, sf):
    return eda.event_type_distribution(ix_orders(spark, sf))


@query
def category_distribution(spark, sf):
    return eda.category_distribution(products(spark, sf))


@query
def rating_histogram(spark, sf):
    return eda.rating_histogram(ix_orders(spark, sf))


@query
def activity_histogram(spark, sf):
    return eda.activity_histogram(ix_orders(spark, sf))


@query
def price_box_stats(spark, sf):
    return eda.price_box_stats(products(spark, sf))


@query
def active_submatrix(spark, sf):
    return eda.active_submatrix(ix_orders(spark, sf))


@query
def submatrix_sparsity(spark, sf):
    return eda.submatrix_sparsity(ix_orders(spark, sf))


PIVOTED = range(1, 41)  # items of the heat map


@query
def submatrix_pivot(spark, sf):
    return eda.submatrix_pivot(ix_orders(spark, sf), PIVOTED)


@query
def day_hour_density(spark, sf):
    return eda.day_hour_density(ix_events(spark, sf))


# -- feature store and runs -----------------------------------------------------------------------------------------


def _store(spark, sf) -> FeatureStore:
    """User features of raw events as version v1 and of clean ones as v2; item activity as v1."""
    store = FeatureStore(spark, scratch_dir(spark, "store"))
    raw = features.user_features(ix_events(spark, sf), AS_OF)
    clean = features.user_features(ix_clean(spark, sf), AS_OF)
    items = features.item_activity_agg(ix_orders(spark, sf)).select("item_id", "total_interactions", "unique_users")
    defs = FEATURE_DEFS["user_features"]
    store.write("user_features", raw, defs, "events", "raw", "user_id", "v1")
    store.write("item_activity", items, infer_feature_defs(items), "lineitem", "orders", "item_id", "v1")
    store.write("user_features", clean, defs, "events", "clean", "user_id", "v2")
    return store


@query
def fs_write(spark, sf):
    return _store(spark, sf).registry().select(
        "name", "version", "entity", "source", "rows", "cols", F.array_join("columns", ",").alias("columns")
    )


@query
def fs_read(spark, sf):
    return _store(spark, sf).read("user_features", columns=["user_id", "activity_score", "avg_rating_given"])


@query
def fs_read_version(spark, sf):
    """An older version by its name."""
    return _store(spark, sf).read("user_features", "v1", ["user_id", "total_interactions", "unique_items"])


@query
def fs_get_version(spark, sf):
    return _store(spark, sf).get_version("user_features", "v1").select("name", "version", "description", "rows", "cols")


@query
def fs_list_groups(spark, sf):
    return _store(spark, sf).list_groups()


@query
def fs_lookup_ids(spark, sf):
    """Lookup by a list of ids, one of them unknown: the lowest and the highest user."""
    bounds = table(spark, sf, "events").agg(F.min("user_id"), F.max("user_id")).first()
    return _store(spark, sf).online_lookup("user_features", [*bounds, -1], "user_id")


@query
def fs_online_lookup(spark, sf):
    ids = table(spark, sf, "events").filter("event_type = 'error'").select("user_id").distinct()
    return _store(spark, sf).online_lookup("user_features", ids, "user_id")


@query
def fs_list_versions(spark, sf):
    versions = _store(spark, sf).list_versions("user_features")
    place = F.row_number().over(W.orderBy("seq")).cast("long")  # one row per version
    return versions.select("version", place.alias("position"))


@query
def fs_registry(spark, sf):
    return _store(spark, sf).latest_of_all().select("name", "version", "rows")


def _inferred(spark, sf):
    """Inferred definitions of a stored group, with the number of values each column holds."""
    store = _store(spark, sf)
    data = store.read("item_activity")
    counted = data.agg(*[F.count(c).alias(c) for c in data.columns])
    rows = [
        F.struct(F.lit(n).alias("feature"), F.lit(t).alias("dtype"), F.lit(d).alias("description"), F.col(n).alias("values"))
        for n, t, d in infer_feature_defs(data)
    ]
    return counted.select(F.inline(F.array(*rows)))


QUERIES["infer_feature_defs"] = _inferred


@query
def feature_catalog(spark, sf):
    store = FeatureStore(spark, scratch_dir(spark, "store"))
    tables = _feature_tables(spark, sf)
    for name, entity in GROUP_ENTITIES.items():
        store.write(name, tables[name], FEATURE_DEFS[name], "features", name, entity, "v1")
    return store.feature_catalog().select("feature_group", "entity", "feature", "dtype")


def _runs(spark, sf) -> DataFrame:
    path = scratch_dir(spark, "runs")
    for name, df in (("events", ix_events(spark, sf)), ("orders", ix_orders(spark, sf)), ("clean", ix_clean(spark, sf))):
        metrics = recommend.interaction_sparsity(df).select("n_users", "n_items", "sparsity")
        runs.log_run(spark, path, "sparsity", metrics, {"view": name}, {"engine": "spark"})
    return runs.read_runs(spark, path)


@query
def log_run(spark, sf):
    return _runs(spark, sf).select(
        "experiment", "status", F.col("params")["view"].alias("view"), F.explode("metrics").alias("metric", "value")
    )


@query
def compare_runs(spark, sf):
    return runs.compare_runs(_runs(spark, sf)).drop("best_run")


@query
def end_to_end_row_counts(spark, sf):
    tables = run_all(
        spark, ix_raw(spark, sf), products(spark, sf), scratch_dir(spark, "run"), AS_OF, ["seq"]
    )
    return row_counts(tables)
