"""Ranking metrics at k from long tables of recommendations and relevant items."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.columns import grid_mean, half_even

# Metric values are averaged in whole billionths, see `grid_mean`.
METRIC_SCALE = 1_000_000_000
RELEVANT_RATING = 3.0  # fixed value


def relevance_ground_truth(test: DataFrame, min_rating: float = RELEVANT_RATING) -> DataFrame:
    """The distinct (user, item) pairs rated at least `min_rating`."""
    return (
        test.filter((F.col("rating") >= min_rating) & F.col("user_id").isNotNull())
        .select("user_id", "item_id")
        .distinct()
    )


def _user_hits(recommended: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Per user with relevant items: their number, the hits in the top k and the gain."""
    relevant = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("relevant"))
    hits = (
        recommended.filter(F.col("rank") <= k)
        .join(truth, ["user_id", "item_id"])
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("hits"),
            F.sum(1.0 / F.log2(F.col("rank") + 1)).alias("gain"),
        )
    )
    return relevant.join(hits, "user_id", "left").na.fill({"hits": 0, "gain": 0.0})


def _ideal_gain(k: int):
    """The best gain for min(relevant, k) hits, from k cumulative constants."""
    total, steps = 0.0, []
    for rank in range(1, k + 1):
        total += 1 / math.log2(rank + 1)
        steps.append(F.lit(total))
    return F.element_at(F.array(*steps), F.least("relevant", F.lit(k)).cast("int"))


def score_users(recommended: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """Precision, recall and NDCG at k per user with relevant items; no list scores 0."""
    if k <= 0:
        zero = F.lit(0.0)
        users = truth.select("user_id").distinct()
        return users.select(
            "user_id", zero.alias("precision"), zero.alias("recall"), zero.alias("ndcg")
        )
    return _user_hits(recommended, truth, k).select(
        "user_id",
        (F.col("hits") / k).alias("precision"),
        (F.col("hits") / F.col("relevant")).alias("recall"),
        (F.col("gain") / _ideal_gain(k)).alias("ndcg"),
    )


def precision_at_k(recommended: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """Hits in the top k over k, even for shorter lists."""
    return score_users(recommended, truth, k).select("user_id", "precision")


def recall_at_k(recommended: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    return score_users(recommended, truth, k).select("user_id", "recall")


def ndcg_at_k(recommended: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    return score_users(recommended, truth, k).select("user_id", "ndcg")


def evaluate_recommendations(
    recommended: DataFrame, truth: DataFrame, users: DataFrame | None = None, k: int = 10
) -> DataFrame:
    """One row: metric means over the users with relevant items, and their number.

    `users` are those predictions were asked for; by default all with relevant items.
    """
    if users is not None:
        truth = truth.join(users.select("user_id").distinct(), "user_id", "left_semi")
    means = {
        f"{name}_at_{k}": half_even(
            F.coalesce(grid_mean(F.col(name), METRIC_SCALE), F.lit(0.0)), 4
        )
        for name in ("precision", "recall", "ndcg")
    }
    return score_users(recommended, truth, k).agg(
        *[value.alias(name) for name, value in means.items()],
        F.count(F.lit(1)).alias("evaluated_users"),
    )
