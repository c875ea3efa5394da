"""The whole job: ingest, validate, prepare, build features, register them, train.

Each step reads the newest written tables below one root and writes its own, so losing an executor repeats
a step's tasks, and a failed run resumes at the step that failed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.functions.ordering import HOT_ROWS
from affinis.operators.cooccurrence import item_jaccard
from affinis.operators.encode import encode_products
from affinis.operators.features import interaction_features, item_features, user_features
from affinis.operators.prepare import clean_interactions, clean_products
from affinis.operators.quality import INTERACTIONS_SUITE, PRODUCTS_SUITE, run_suite
from affinis.operators.recommend import train_content, train_svd
from affinis.session import pin
from affinis.sources.checks import missing_columns
from affinis.sources.feature_store import FEATURE_DEFS, GROUP_ENTITIES, FeatureStore
from affinis.sources.readers import read_feature_table, scan_latest_snapshot
from affinis.sources.runs import log_run, read_runs, start_time
from affinis.sources.writers import (
    write_feature_tables,
    write_processed_snapshot,
    write_raw_snapshot,
)


FEATURE_NAMES = ("user_features", "item_features", "interaction_features", "item_cooccurrence")
RAW_INTERACTIONS, RAW_PRODUCTS = "raw/interactions", "raw/products"
CLEAN, CATALOG = "interactions_clean", "products_encoded"


def _newest(spark: SparkSession, path: str) -> DataFrame:
    return scan_latest_snapshot(spark, path).drop("ingest_ts")


def ingest(interactions: DataFrame, products: DataFrame, root: str) -> None:
    """Append raw snapshots; interactions without a required column are refused."""
    missing = missing_columns(interactions)
    if missing:
        raise ValueError(f"interactions lack {missing}")
    write_raw_snapshot(interactions, f"{root}/{RAW_INTERACTIONS}", "parquet")
    write_raw_snapshot(products, f"{root}/{RAW_PRODUCTS}", "parquet")


def validate(spark: SparkSession, root: str) -> None:
    """Report both suites on the newest raw snapshots; failed rules do not stop the run."""
    raw = _newest(spark, f"{root}/{RAW_INTERACTIONS}")
    catalog = _newest(spark, f"{root}/{RAW_PRODUCTS}")
    run_suite(raw, "interactions", INTERACTIONS_SUITE).unionByName(
        run_suite(catalog, "products", PRODUCTS_SUITE)
    ).write.mode("overwrite").parquet(f"{root}/quality")


def prepare(
    spark: SparkSession,
    root: str,
    tiebreak: Sequence[str] = (),
    product_order: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> None:
    """Clean interactions, clean and encode the catalog."""
    cleaned = clean_interactions(
        _newest(spark, f"{root}/{RAW_INTERACTIONS}"), tiebreak, hot_rows=hot_rows
    )
    write_processed_snapshot(cleaned, f"{root}/processed", CLEAN)
    catalog = pin(clean_products(_newest(spark, f"{root}/{RAW_PRODUCTS}"), product_order, hot_rows))
    write_processed_snapshot(encode_products(catalog, hot_rows)[0], f"{root}/processed", CATALOG)


def engineer(spark: SparkSession, root: str, as_of: str | None = None) -> None:
    """Replace the four feature tables."""
    clean = _newest(spark, f"{root}/processed/{CLEAN}")
    tables = {
        "user_features": user_features(clean, as_of),
        "item_features": item_features(clean, _newest(spark, f"{root}/processed/{CATALOG}"), as_of),
        "interaction_features": interaction_features(clean),
        "item_cooccurrence": item_jaccard(clean),
    }
    write_feature_tables(tables, f"{root}/features")


def register(spark: SparkSession, root: str) -> None:
    """Write three feature tables as new versions of their groups."""
    store = FeatureStore(spark, f"{root}/store")
    for name, entity in GROUP_ENTITIES.items():
        table = read_feature_table(spark, f"{root}/features", name)
        store.write(name, table, FEATURE_DEFS[name], "feature tables", name, entity)


def train(
    spark: SparkSession,
    root: str,
    tiebreak: Sequence[str] = (),
    n_components: int = 50,
    k: int = 10,
    hot_rows: int = HOT_ROWS,
) -> None:
    """Train and evaluate both models, keep factors and recommendations, log two runs."""
    started = start_time()
    clean = _newest(spark, f"{root}/processed/{CLEAN}")
    svd = train_svd(clean, n_components, k, ["timestamp", *tiebreak, "item_id"], hot_rows)
    for name, table in {
        "svd_user_factors": svd.model.user_factors,
        "svd_item_factors": svd.model.item_factors,
        "svd_recommendations": svd.recommendations,
    }.items():
        table.write.mode("overwrite").parquet(f"{root}/models/{name}")
    metrics = svd.metrics.withColumnsRenamed(
        {f"{m}_at_{k}": f"{m}@{k}" for m in ("precision", "recall", "ndcg")}
    )
    log_run(
        spark, f"{root}/runs", "svd_collaborative_filtering", metrics,
        {"n_components": n_components, "k": k, "model_type": "SVD",
         "split_strategy": "per_user_last_20pct"},
        {"framework": "spark"}, started=started,
    )
    started = start_time()
    items = read_feature_table(spark, f"{root}/features", "item_features")
    log_run(
        spark, f"{root}/runs", "content_based_filtering",
        train_content(items).withColumnRenamed("category_consistency", "category_consistency@5"),
        {"model_type": "ContentBased", "similarity": "cosine"}, started=started,
    )


def produced(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every written table below `root`."""
    return {
        "interactions_raw": _newest(spark, f"{root}/{RAW_INTERACTIONS}"),
        "products_raw": _newest(spark, f"{root}/{RAW_PRODUCTS}"),
        "quality_results": spark.read.parquet(f"{root}/quality"),
        CLEAN: _newest(spark, f"{root}/processed/{CLEAN}"),
        CATALOG: _newest(spark, f"{root}/processed/{CATALOG}"),
        **{name: read_feature_table(spark, f"{root}/features", name) for name in FEATURE_NAMES},
        "feature_registry": FeatureStore(spark, f"{root}/store").registry(),
        "experiment_runs": read_runs(spark, f"{root}/runs"),
    }


def run_all(
    spark: SparkSession,
    interactions: DataFrame,
    products: DataFrame,
    root: str,
    as_of: str | None = None,
    tiebreak: Sequence[str] = (),
    product_order: Sequence[str] = (),
    n_components: int = 50,
    k: int = 10,
    hot_rows: int = HOT_ROWS,
) -> dict[str, DataFrame]:
    """All steps in order; each also runs alone, since every step reads what the last one wrote."""
    ingest(interactions, products, root)
    validate(spark, root)
    prepare(spark, root, tiebreak, product_order, hot_rows)
    engineer(spark, root, as_of)
    register(spark, root)
    train(spark, root, tiebreak, n_components, k, hot_rows)
    return produced(spark, root)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of every produced table; counts of written Parquet come from its footers."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
