"""Recommendations from factors, item similarity, and the two training jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.functions.columns import half_even
from affinis.functions.ordering import HOT_ROWS
from affinis.functions.tiles import top_candidates
from affinis.operators.evaluate import evaluate_recommendations, relevance_ground_truth
from affinis.operators.split import temporal_holdout_split
from affinis.operators.svd import GRAM_LIMIT, SvdModel, explained_variance, truncated_svd
from affinis.session import pin, release_shuffles

# Content features in their order, and the number of neighbours compared.
CONTENT_FEATURES = [
    "price_normalized", "category_encoded", "popularity_score", "avg_rating_received",
    "total_interactions",
]
CONSISTENCY_NEIGHBOURS = 5


def interaction_sparsity(df: DataFrame) -> DataFrame:
    """Users, items, interactions and the empty share of the user x item matrix."""
    return df.agg(
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
        F.count(F.lit(1)).alias("n_interactions"),
    ).withColumn(
        "sparsity",
        1 - F.try_divide(
            F.col("n_interactions").cast("double"),
            F.col("n_users").cast("double") * F.col("n_items"),
        ),
    )


def recommend_top_k(
    model: SvdModel,
    users: DataFrame | None = None,
    seen: DataFrame | None = None,
    n: int = 10,
    digits: int | None = 6,
    **tiles: int,
) -> DataFrame:
    """(user_id, item_id, score, rank) by factor product, without items rated above zero.

    Scores are rounded to `digits`, so what differs only by the order in which factors were summed ranks as a tie, by item.
    Users the model does not know get no rows.
    """
    factors = model.user_factors
    if users is not None:
        factors = factors.join(users.select("user_id").distinct(), "user_id", "left_semi")
    excluded = None
    if seen is not None:
        excluded = seen.filter(F.col("rating") > 0).select(
            F.col("user_id").alias("query_id"), "item_id"
        )
    queries = pin(factors.withColumnRenamed("user_id", "query_id"))
    best = top_candidates(queries, model.item_factors, n, excluded, digits, **tiles)
    return best.withColumnRenamed("query_id", "user_id")


def _unit_vectors(items: DataFrame, features: Sequence[str], standardize: bool) -> DataFrame:
    """One unit vector per item; all-zero features stay a zero vector."""
    present = [c for c in features if c in items.columns]
    values = items.select(
        "item_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in present]
    )
    if standardize:
        stats = values.agg(
            F.struct(
                *[F.avg(c).alias(f"m_{c}") for c in present],
                *[F.stddev_pop(c).alias(f"s_{c}") for c in present],
            )
        ).scalar()
        values = values.select(
            "item_id",
            *[
                F.coalesce(
                    F.try_divide(F.col(c) - stats[f"m_{c}"], stats[f"s_{c}"]), F.lit(0.0)
                ).alias(c)
                for c in present
            ],
        )
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in present), F.lit(0.0)))
    with_norm = values.withColumn("_norm", norm)
    unit = F.array(
        *[F.when(F.col("_norm") > 0, F.col(c) / F.col("_norm")).otherwise(0.0) for c in present]
    )
    return with_norm.select("item_id", unit.alias("vector"))


def item_similarity_top_n(
    items: DataFrame,
    features: Sequence[str] = tuple(CONTENT_FEATURES),
    n: int = 10,
    only: DataFrame | None = None,
    standardize: bool = False,
    digits: int = 6,
    **tiles: int,
) -> DataFrame:
    """(item_id, similar_id, similarity, rank): nearest items by cosine, itself excluded.

    Features the table lacks are skipped and nulls count as 0. `only` (item_id) limits for which
    items neighbours are searched, not among which. Items of one vector have the same neighbours but for themselves, so every
    different vector is searched once, among the different vectors; each stands for its first n + 1 items.
    """
    spark = items.sparkSession
    vectors = pin(_unit_vectors(items, features, standardize))
    release_shuffles(spark)  # what the features were made from
    place = F.row_number().over(W.partitionBy("vector").orderBy("item_id"))
    groups = pin(
        vectors.withColumn("place", place)
        .filter(F.col("place") <= n + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
        .select(F.col("ids")[0].alias("item_id"), "vector", "ids")
    )
    asked = vectors if only is None else vectors.join(only.select("item_id"), "item_id", "left_semi")
    members = asked.join(groups.select(F.col("item_id").alias("query_id"), "vector"), "vector").select(
        "item_id", "query_id"
    )
    queries = groups.select(F.col("item_id").alias("query_id"), "vector")
    if only is not None:
        members = pin(members)
        queries = pin(queries.join(members.select("query_id").distinct(), "query_id", "left_semi"))
    best = top_candidates(queries, groups.select("item_id", "vector"), n + 1, digits=digits, **tiles)
    each = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("away"), i.alias("similar_id")))
    lists = pin(
        best.join(groups.select("item_id", "ids"), "item_id")
        .groupBy("query_id")
        .agg(F.array_sort(F.flatten(F.collect_list(each))).alias("near"))
        .select("query_id", F.slice("near", 1, n + 1).alias("near"))
    )
    release_shuffles(spark)
    others = F.filter("near", lambda x: x["similar_id"] != F.col("item_id"))
    return (
        members.join(lists, "query_id")
        .select("item_id", F.posexplode(F.slice(others, 1, n)).alias("at", "x"))
        .select(
            "item_id",
            F.col("x.similar_id").alias("similar_id"),
            (F.lit(0.0) - F.col("x.away")).alias("similarity"),
            (F.col("at") + 1).cast("long").alias("rank"),
        )
    )


def category_consistency(
    items: DataFrame,
    features: Sequence[str] = tuple(CONTENT_FEATURES),
    neighbours: int = CONSISTENCY_NEIGHBOURS,
    sample: int | None = None,
) -> DataFrame:
    """One row: mean share of nearest items in the same category, over all items.

    `sample` looks at the first items by id only.
    """
    first = items.select("item_id").orderBy("item_id").limit(sample) if sample else None
    near = item_similarity_top_n(items, features, neighbours, only=first)
    mine = items.select("item_id", F.col("category").alias("_mine"))
    theirs = items.select(F.col("item_id").alias("similar_id"), F.col("category").alias("_theirs"))
    same = F.coalesce(F.col("_mine") == F.col("_theirs"), F.lit(False))
    shares = (
        near.join(mine, "item_id")
        .join(theirs, "similar_id")
        .groupBy("item_id")
        .agg(F.avg(same.cast("double")).alias("share"))
    )
    return shares.agg(
        half_even(F.coalesce(F.avg("share"), F.lit(0.0)), 4).alias("category_consistency"),
        F.count(F.lit(1)).alias("items_checked"),
    )


@dataclass
class SvdTraining:
    model: SvdModel
    recommendations: DataFrame
    metrics: DataFrame


def train_svd(
    df: DataFrame,
    n_components: int = 50,
    k: int = 10,
    order: Sequence[str] = ("timestamp",),
    hot_rows: int = HOT_ROWS,
    gram_limit: int = GRAM_LIMIT,
) -> SvdTraining:
    """Split, fit, recommend to the test users, evaluate; `metrics` is one row."""
    split = pin(temporal_holdout_split(df, order, hot_rows=hot_rows))
    train, test = split.filter("NOT is_test"), split.filter("is_test")
    model = truncated_svd(train, n_components, gram_limit)
    users = test.select("user_id").distinct()
    recommended = pin(recommend_top_k(model, users, train, k))
    quality = evaluate_recommendations(recommended, relevance_ground_truth(test), users, k)
    per_user = split.groupBy("user_id").agg(
        F.count_if(~F.col("is_test")).alias("train"), F.count_if(F.col("is_test")).alias("test")
    )
    sizes = per_user.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(F.col("train") > 0).alias("train_users"),
        F.count_if(F.col("test") > 0).alias("test_users"),
        F.sum("train").alias("train_rows"),
        F.sum("test").alias("test_rows"),
    )
    sizes = sizes.withColumn(
        "n_items", split.agg(F.count_distinct("item_id")).scalar()
    ).select(F.struct("*").alias("s"))
    cells = F.col("s.n_users").cast("double") * F.col("s.n_items")
    rows = F.col("s.train_rows") + F.col("s.test_rows")
    metrics = (
        quality.withColumn(
            "explained_variance",
            half_even(explained_variance(train, model).scalar(), 4),
        )
        .withColumn("s", sizes.scalar())
        .withColumn("sparsity", half_even(1 - rows / cells, 4))
        .select("*", "s.*")
        .drop("s")
    )
    return SvdTraining(model, recommended, metrics)


def train_content(items: DataFrame) -> DataFrame:
    """One row: the consistency metric of content neighbours and the number of items."""
    counted = items.agg(F.count(F.lit(1))).scalar()
    return category_consistency(items).withColumn("n_items", counted)
