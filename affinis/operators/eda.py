"""Exploratory aggregates of cleaned interactions and catalogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.columns import as_timestamp, half_even, stable_mean
from affinis.functions.ordering import HOT_ROWS, quantiles, with_position
from affinis.session import pin

# Histogram edges, heatmap and list sizes, day names in order.
RATING_EDGES = [0.95, 1.45, 1.95, 2.45, 2.95, 3.45, 3.95, 4.45, 4.95, 5.05]
ACTIVITY_BINS = 30
HEATMAP_USERS, HEATMAP_ITEMS = 50, 80
SUMMARY_ITEMS = 10
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _counts(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def _item_counts(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.count("user_id").alias("interactions"))
    )


def _user_counts(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count("item_id").alias("interactions"))
    )


def top_items(df: DataFrame, n: int = 10) -> DataFrame:
    return _item_counts(df).orderBy(F.desc("interactions"), "item_id").limit(n)


def popularity_rank(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every item with its rank by interactions (from 1), ties by item."""
    placed = with_position(_item_counts(df), [F.desc("interactions"), F.col("item_id")], "rank", hot_rows)
    return placed.withColumn("rank", F.col("rank") + 1)


def rating_distribution(df: DataFrame) -> DataFrame:
    return _counts(df, "rating", "count")


def _activity_stats(users: DataFrame) -> DataFrame:
    per_count = users.groupBy("interactions").agg(F.count(F.lit(1)).alias("users"))
    total = F.sum(F.col("interactions") * F.col("users")).cast("double")
    return per_count.agg(
        F.min("interactions").alias("min"),
        F.max("interactions").alias("max"),
        half_even(F.try_divide(total, F.sum("users").cast("double")), 2).alias("mean"),
        half_even(F.percentile("interactions", F.lit(0.5), F.col("users")), 2).alias("median"),
    )


def user_activity_stats(df: DataFrame) -> DataFrame:
    """Least, most, mean and median number of interactions per user.

    The median comes from how many users have each count: with n rows there are at most
    sqrt(2 n) different counts.
    """
    return _activity_stats(_user_counts(df))


def event_type_distribution(df: DataFrame) -> DataFrame:
    """Count and percentage per event type."""
    if "event_type" not in df.columns:
        return df.sparkSession.createDataFrame([], "event_type STRING, count BIGINT, pct DOUBLE")
    counts = pin(_counts(df, "event_type", "count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", half_even(F.col("count") * 100.0 / total, 1))


def category_distribution(products: DataFrame) -> DataFrame:
    if "category" not in products.columns:
        return products.sparkSession.createDataFrame([], "category STRING, count BIGINT")
    return _counts(products, "category", "count")


def _bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Bins [a, b), the last one [a, b]; null outside."""
    chosen = F.lit(None).cast("long")
    last = len(edges) - 2
    for i in range(last, -1, -1):
        below = value <= edges[i + 1] if i == last else value < edges[i + 1]
        chosen = F.when((value >= edges[i]) & below, F.lit(i).cast("long")).otherwise(chosen)
    return chosen


def rating_histogram(df: DataFrame, edges: Sequence[float] = tuple(RATING_EDGES)) -> DataFrame:
    """Number of ratings per bin, empty bins included, from one aggregate."""
    chosen = _bin_of(F.col("rating"), edges)
    bins = range(len(edges) - 1)
    counted = df.select(chosen.alias("b")).agg(*[F.count_if(F.col("b") == i).alias(f"b{i}") for i in bins])
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("bin"),
            F.lit(float(edges[i])).alias("low"),
            F.lit(float(edges[i + 1])).alias("high"),
            F.col(f"b{i}").alias("count"),
        )
        for i in bins
    ]
    return counted.select(F.inline(F.array(*rows)))


def activity_histogram(df: DataFrame, bins: int = ACTIVITY_BINS) -> DataFrame:
    """Users per equal-width bin of their interaction count; equal counts span one unit."""
    per_count = pin(
        _user_counts(df).groupBy("interactions").agg(F.count(F.lit(1)).alias("users"))
    )
    span = per_count.agg(
        F.struct(
            F.min("interactions").cast("double").alias("low"),
            F.max("interactions").cast("double").alias("high"),
        )
    ).scalar()
    flat = span["low"] == span["high"]
    low = F.when(flat, span["low"] - 0.5).otherwise(span["low"])
    width = F.when(flat, F.lit(1.0)).otherwise(span["high"] - span["low"]) / bins
    chosen = F.least(F.floor((F.col("interactions") - low) / width), F.lit(bins - 1)).cast("long")
    return (
        per_count.select(chosen.alias("bin"), "users")
        .groupBy("bin")
        .agg(F.sum("users").alias("users"))
        .select("bin", half_even(low + F.col("bin") * width, 6).alias("low"), "users")
    )


def price_box_stats(products: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Quartiles per category and the furthest prices within 1.5 interquartile ranges."""
    priced = products.filter(F.col("category").isNotNull() & F.col("price").isNotNull())
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    boxes = quantiles(priced, ["category"], "price", points, hot_rows)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("price").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        priced.select("category", "price")
        .join(boxes, "category")
        .groupBy("category")
        .agg(
            *[half_even(F.max(p), 4).alias(p) for p in points],
            F.min(F.when(inside, F.col("price"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("price"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def _most(df: DataFrame, key: str, n: int) -> DataFrame:
    return _counts(df, key, "_n").orderBy(F.desc("_n"), key).limit(n).select(key)


def active_submatrix(
    df: DataFrame, users: int = HEATMAP_USERS, items: int = HEATMAP_ITEMS
) -> DataFrame:
    """Mean rating per cell of the most active users and the most used items, in long form."""
    picked = df.join(_most(df, "user_id", users), "user_id", "left_semi").join(
        _most(df, "item_id", items), "item_id", "left_semi"
    )
    return (
        picked.groupBy("user_id", "item_id")
        .agg(half_even(stable_mean(F.col("rating")), 4).alias("rating"))
        .filter(F.col("rating").isNotNull())
    )


def submatrix_sparsity(
    df: DataFrame, users: int = HEATMAP_USERS, items: int = HEATMAP_ITEMS
) -> DataFrame:
    """One row: the empty share of `active_submatrix`."""
    rows = _most(df, "user_id", users).agg(F.count(F.lit(1))).scalar()
    columns = _most(df, "item_id", items).agg(F.count(F.lit(1))).scalar()
    cells = active_submatrix(df, users, items).agg(F.count(F.lit(1)).alias("filled"))
    return cells.select(
        "filled", half_even(1 - F.col("filled") / (rows * columns).cast("double"), 4).alias("sparsity")
    )


def submatrix_pivot(df: DataFrame, items: Sequence[int], users: int = HEATMAP_USERS) -> DataFrame:
    """The cells as one row per user and one column per listed item, empty cells 0."""
    cells = df.join(_most(df, "user_id", users), "user_id", "left_semi").filter(
        F.col("item_id").isin(list(items))
    )
    return (
        cells.groupBy("user_id")
        .pivot("item_id", list(items))
        .agg(half_even(stable_mean(F.col("rating")), 4))
        .na.fill(0.0)
    )


def day_hour_density(df: DataFrame) -> DataFrame:
    """Interactions per weekday (rows, with the day's place in the week) and hour (columns)."""
    at = as_timestamp(df, "timestamp")
    timed = df.select(F.weekday(at).alias("d"), F.hour(at).alias("h")).filter("d IS NOT NULL")
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return (
        timed.groupBy("d")
        .agg(*[F.count_if(F.col("h") == h).alias(f"h{h:02d}") for h in range(24)])
        .select(
            F.col("d").cast("long").alias("day_of_week"),
            F.element_at(names, F.col("d") + 1).alias("day"),
            *[f"h{h:02d}" for h in range(24)],
        )
    )


def eda_summary(df: DataFrame, products: DataFrame) -> DataFrame:
    """All summary figures as (section, key, value).

    The interactions are read once per counted column; every figure then comes from the counts per
    user, item and rating.
    """
    users, items = pin(_user_counts(df)), pin(_item_counts(df))
    ratings = pin(df.groupBy("rating").agg(F.count(F.lit(1)).alias("count")))
    n_users = users.agg(F.count(F.lit(1))).scalar().cast("double")
    n_items = items.agg(F.count(F.lit(1))).scalar().cast("double")

    def rows(section: str, source: DataFrame, key: Column, value: Column) -> DataFrame:
        return source.select(
            F.lit(section).alias("section"),
            key.cast("string").alias("key"),
            value.cast("double").alias("value"),
        )

    def unpivoted(section: str, source: DataFrame) -> DataFrame:
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in source.columns)
        long = source.selectExpr(f"stack({len(source.columns)}, {pairs}) AS (k, v)")
        return rows(section, long, F.col("k"), F.col("v"))

    x, n = F.col("rating"), F.col("count")
    rated = F.sum(F.when(x.isNotNull(), n)).cast("double")
    mean = stable_mean(x, n)
    totals = (
        ratings.agg(
            F.sum(n).alias("n_interactions"),
            mean.alias("mean"),
            F.sum(x * x * n).alias("squares"),
            rated.alias("rated"),
        )
        .withColumn("n_users", n_users)
        .withColumn("n_items", n_items)
        .select(
            "n_users",
            "n_items",
            "n_interactions",
            half_even(
                (1 - F.try_divide(F.col("n_interactions"), F.col("n_users") * F.col("n_items"))) * 100, 2
            ).alias("sparsity_pct"),
            half_even(F.col("mean"), 3).alias("avg_rating"),
            half_even(
                F.sqrt(
                    F.try_divide(
                        F.greatest(
                            F.col("squares") - F.col("rated") * F.col("mean") * F.col("mean"), F.lit(0.0)
                        ),
                        F.when(F.col("rated") > 1, F.col("rated") - 1),
                    )
                ),
                3,
            ).alias("rating_std"),
        )
    )
    top = items.orderBy(F.desc("interactions"), "item_id").limit(SUMMARY_ITEMS)
    parts = [
        unpivoted("totals", totals),
        rows("rating_distribution", ratings.filter(x.isNotNull()), x, n),
        rows("top_10_items", top, F.col("item_id"), F.col("interactions")),
        unpivoted("user_activity", _activity_stats(users)),
    ]
    if "event_type" in df.columns:
        parts.append(rows("event_types", _counts(df, "event_type", "count"), F.col("event_type"), n))
    if "category" in products.columns:
        parts.append(
            rows("product_categories", category_distribution(products), F.col("category"), n)
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
