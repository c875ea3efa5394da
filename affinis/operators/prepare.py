"""Cleaning of interactions and catalogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.columns import as_timestamp, clip, half_even
from affinis.functions.ordering import HOT_ROWS, fits_one_task, quantiles, weighted_quantiles
from affinis.operators.dedup import dedup_keep_first, dedup_keep_latest
from affinis.session import pin


def drop_null_keys(df: DataFrame, keys: Sequence[str] = ("user_id", "item_id")) -> DataFrame:
    return df.na.drop(subset=list(keys))


def impute_group_median(
    df: DataFrame, key: str = "user_id", value: str = "rating", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Missing values become the group's median; what is left, the median after that fill.

    Both medians come from one reduced table of (group, value) counts: a fill adds the group's
    median as often as the group misses a value, so the filled rows need not exist to be counted.
    """
    counts = pin(df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n")))
    small = fits_one_task(counts, hot_rows)
    grouped = counts.filter(F.col(key).isNotNull())
    medians = weighted_quantiles(grouped, [key], value, "_n", {"_median": 0.5}, hot_rows, small)
    missing = grouped.filter(F.col(value).isNull()).select(key, F.col("_n").alias("_missing"))
    fills = medians.join(missing, key).select(
        F.col("_median").alias(value), F.col("_missing").alias("_n")
    )
    after = counts.filter(F.col(value).isNotNull()).select(value, "_n").unionByName(fills)
    overall = weighted_quantiles(after, [], value, "_n", {"_median": 0.5}, hot_rows, small)
    return (
        df.join(medians, key, "left")
        .withColumn(value, F.coalesce(F.col(value), F.col("_median"), overall.scalar()))
        .select(*df.columns)
    )


def clip_range(df: DataFrame, column: str, low: float | None, high: float | None) -> DataFrame:
    return df.withColumn(column, clip(F.col(column), low, high))


def count_clipped(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """How many values `clip_range` would move."""
    outside = (F.col(column) < low) | (F.col(column) > high)
    return df.agg(F.count_if(outside).alias("clipped"))


def normalize_types(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Whole-number ids and ratings to one decimal; `lenient` nulls what cannot be cast."""
    def typed(name: str, kind: str):
        return F.col(name).try_cast(kind) if lenient else F.col(name).cast(kind)

    return (
        df.withColumn("user_id", typed("user_id", "long"))
        .withColumn("item_id", typed("item_id", "long"))
        .withColumn("rating", half_even(typed("rating", "double"), 1))
    )


def parse_timestamps(df: DataFrame, column: str = "timestamp", drop_bad: bool = True) -> DataFrame:
    """Text to timestamp; unreadable text becomes null and, by default, its row goes."""
    parsed = df.withColumn(column, as_timestamp(df, column))
    return parsed.filter(F.col(column).isNotNull()) if drop_bad else parsed


def count_bad_timestamps(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """How many rows `parse_timestamps` would drop."""
    return df.agg(F.count_if(as_timestamp(df, column).isNull()).alias("bad_timestamps"))


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill nulls of the listed columns; columns the table lacks are skipped."""
    wanted = {"category": "unknown", "in_stock": True} if defaults is None else defaults
    return df.na.fill({c: v for c, v in wanted.items() if c in df.columns})


def repair_nonpositive(
    df: DataFrame, column: str = "price", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Values of zero or less become the median of the positive ones; nulls stay."""
    positive = df.filter(F.col(column) > 0)
    median = quantiles(positive, [], column, {"_median": 0.5}, hot_rows)
    fixed = F.when(F.col(column) <= 0, median.scalar()).otherwise(F.col(column))
    return df.withColumn(column, fixed)


def clean_interactions(
    df: DataFrame,
    tiebreak: Sequence[str] = (),
    parse_first: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Keys, ratings, duplicates, types and times, in that order; one row per (user, item)."""
    keyed = drop_null_keys(df)
    rated = clip_range(impute_group_median(keyed, hot_rows=hot_rows), "rating", 1.0, 5.0)
    latest = dedup_keep_latest(rated, tiebreak=tiebreak, parse_first=parse_first)
    return parse_timestamps(normalize_types(latest))


def clean_products(
    df: DataFrame, order: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per item, default category and stock flag, positive prices, bounded ratings.

    `order` names the columns that say which duplicate came first; by default all others.
    """
    order = list(order) or [c for c in df.columns if c != "item_id"]
    unique = dedup_keep_first(df, ["item_id"], order)
    priced = repair_nonpositive(fill_defaults(unique), hot_rows=hot_rows)
    return clip_range(priced, "rating", 0.0, 5.0) if "rating" in df.columns else priced
