"""User, item and interaction feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.columns import (
    MICRO,
    as_timestamp,
    fixed_point,
    half_even,
    is_fixed_point,
    moment,
    stable_mean,
    time_text,
)
from affinis.operators.dedup import dedup_keep_first
from affinis.schemas import EVENT_TYPES
from affinis.session import pin, release_shuffles

# Engagement weights and the recency of users without a valid time.
EVENT_WEIGHTS = {"purchase": 4, "wishlist": 2, "cart": 2, "view": 1}
NO_RECENCY_DAYS = 999.0


def _distinct(column: str, approximate: bool) -> Column:
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def _user_activity(approximate: bool = False) -> list[Column]:
    return [
        F.count("item_id").alias("total_interactions"),
        _distinct("item_id", approximate).alias("unique_items"),
        stable_mean(F.col("rating")).alias("avg_rating_given"),
        F.stddev_samp("rating").alias("std_rating_given"),
        F.max("_time").alias("last_interaction"),
    ]


def _event_counts(df: DataFrame) -> list[Column]:
    """Counts per event type; zero for a table without the column."""
    if "event_type" not in df.columns:
        return [F.lit(0).cast("long").alias(f"{e}_count") for e in EVENT_TYPES]
    return [F.count_if(F.col("event_type") == e).alias(f"{e}_count") for e in EVENT_TYPES]


def _by_user(df: DataFrame):
    known = df.filter(F.col("user_id").isNotNull())
    if "timestamp" in df.columns:
        known = known.withColumn("_time", as_timestamp(df, "timestamp"))
    return known.groupBy("user_id")


def user_activity_agg(df: DataFrame, approximate: bool = False) -> DataFrame:
    return _by_user(df).agg(*_user_activity(approximate))


def event_type_counts(df: DataFrame) -> DataFrame:
    return _by_user(df).agg(*_event_counts(df))


def activity_score(weights: dict[str, int] | None = None) -> Column:
    """Weighted sum of the event counts."""
    score = F.lit(0).cast("long")
    for event, weight in (weights or EVENT_WEIGHTS).items():
        score = score + F.col(f"{event}_count") * weight
    return score


def recency_days(last: Column, as_of: str | None) -> Column:
    """Days from `last` to `as_of`, two decimals; 999 when there is no time."""
    micros = F.unix_micros(moment(as_of)) - F.unix_micros(last)
    days = micros.cast("double") / F.lit(1e6) / F.lit(86400.0)
    return half_even(F.coalesce(days, F.lit(NO_RECENCY_DAYS)), 2)


def user_features(
    df: DataFrame,
    as_of: str | None = None,
    weights: dict[str, int] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """One row per user from a single grouping of the interactions.

    The exact distinct count shuffles by (user, item) first, which also splits very active users;
    `approximate=True` saves that shuffle on tables too large for it.
    """
    return (
        _by_user(df)
        .agg(*_user_activity(approximate), *_event_counts(df))
        .select(
            "user_id",
            "total_interactions",
            "unique_items",
            half_even(F.col("avg_rating_given"), 4).alias("avg_rating_given"),
            half_even(F.coalesce("std_rating_given", F.lit(0.0)), 4).alias("std_rating_given"),
            *[f"{e}_count" for e in EVENT_TYPES],
            activity_score(weights).alias("activity_score"),
            recency_days(F.col("last_interaction"), as_of).alias("recency_days"),
            time_text(moment(as_of)).alias("created_at"),
        )
    )


def _released(df: DataFrame) -> DataFrame:
    """`df` written once, without the shuffle files that it took."""
    written = pin(df)
    release_shuffles(df.sparkSession)
    return written


def item_activity_agg(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per item. The exact distinct count has a grouping of its own, so what is held per (item, user) is only that pair.

    The interactions are written once for both, and the shuffle files of a step go before the next step starts.
    """
    known = df.filter(F.col("item_id").isNotNull())
    figures = [
        F.count("user_id").alias("total_interactions"),
        stable_mean(F.col("rating")).alias("avg_rating_received"),
        F.stddev_samp("rating").alias("std_rating_received"),
    ]
    if approximate:
        out = known.groupBy("item_id").agg(*figures, _distinct("user_id", True).alias("unique_users"))
    else:
        known = _released(known.select("item_id", "user_id", "rating"))
        totals = _released(known.groupBy("item_id").agg(*figures))
        pairs = known.filter(F.col("user_id").isNotNull()).select("item_id", "user_id").distinct()
        users = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("unique_users"))
        out = totals.join(users, "item_id", "left").na.fill({"unique_users": 0})
    return out.select("item_id", "total_interactions", "unique_users", "avg_rating_received", "std_rating_received")


def popularity_score(items: DataFrame, count: str = "total_interactions") -> DataFrame:
    """Add the log of the interaction count, scaled to [0, 1] over all items.

    The items (one row each) are written first: their bounds and the scaling then read them back
    instead of aggregating the interactions twice.
    """
    items = pin(items)
    bounds = items.select(F.col(count)).agg(
        F.struct(F.log1p(F.min(count)).alias("low"), F.log1p(F.max(count)).alias("high"))
    ).scalar()
    scaled = (F.log1p(count) - bounds["low"]) / (bounds["high"] - bounds["low"] + F.lit(1e-9))
    return items.withColumn("popularity_score", half_even(scaled, 4))


CATALOG_COLUMNS = ["category", "price", "price_normalized", "brand", "category_encoded"]


def join_catalog(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Left join of the catalog columns that exist; Spark picks the strategy by size."""
    present = [c for c in CATALOG_COLUMNS if c in catalog.columns]
    return items.join(catalog.select("item_id", *present), "item_id", "left")


def item_features(df: DataFrame, catalog: DataFrame, as_of: str | None = None) -> DataFrame:
    joined = join_catalog(popularity_score(item_activity_agg(df)), catalog)
    present = [c for c in CATALOG_COLUMNS if c in joined.columns]
    return joined.select(
        "item_id",
        "total_interactions",
        "unique_users",
        half_even(F.col("avg_rating_received"), 4).alias("avg_rating_received"),
        half_even(F.coalesce("std_rating_received", F.lit(0.0)), 4).alias("std_rating_received"),
        "popularity_score",
        *present,
        time_text(moment(as_of)).alias("created_at"),
    )


def time_parts(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Add hour, weekday (Monday is 0) and the weekend flag; without a time: null, null, 0."""
    at = as_timestamp(df, time)
    return (
        df.withColumn("hour_of_day", F.hour(at).cast("long"))
        .withColumn("day_of_week", F.weekday(at).cast("long"))
        .withColumn("is_weekend", F.when(F.weekday(at) >= 5, 1).otherwise(0).cast("long"))
    )


def user_rating_gap(df: DataFrame) -> DataFrame:
    """Add the rating's distance from the user's mean.

    The mean comes from a grouping joined back, not a window: partial sums shrink before the
    shuffle, and a very active user's rows stay splittable in the join.
    """
    sums = (
        df.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.try_sum(F.when(is_fixed_point(F.col("rating")), fixed_point(F.col("rating")))).alias("_sum"),
            F.count_if(~is_fixed_point(F.col("rating"))).alias("_other"),
            stable_mean(F.col("rating")).alias("_mean"),
            F.count("rating").alias("_rated"),
        )
    )
    numerator = fixed_point(F.col("rating")) * F.col("_rated") - F.col("_sum")
    # Decimals are subtracted as whole millionths, so the gap has no rounding error of its own.
    gap = F.when(F.col("_other") == 0, numerator.cast("double") / (F.col("_rated") * F.lit(float(MICRO)))).otherwise(
        F.col("rating") - F.col("_mean")
    )
    return (
        df.join(sums, "user_id", "left")
        .withColumn("user_item_gap", half_even(F.when(F.col("_rated") > 0, gap), 4))
        .select(*df.columns, "user_item_gap")
    )


def interaction_features(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Per pair: time parts and rating gap; the first row per pair by `order` stays."""
    featured = time_parts(user_rating_gap(df))
    order = list(order) or [c for c in ("timestamp", "rating", "event_type") if c in df.columns]
    kept = dedup_keep_first(featured, ["user_id", "item_id"], order)
    columns = [
        "user_id", "item_id", "rating", "hour_of_day", "day_of_week", "is_weekend", "user_item_gap",
    ]
    if "event_type" in df.columns:
        columns.append("event_type")
    return kept.select(*columns, time_text(as_timestamp(df, "timestamp")).alias("timestamp"))


def join_event_counts(users: DataFrame, df: DataFrame, event: str) -> DataFrame:
    """Left join of one event type's count per user, 0 where there is none."""
    name = f"{event}_count"
    counted = (
        df.filter((F.col("event_type") == event) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias(name))
    )
    return users.join(counted, "user_id", "left").na.fill({name: 0})
