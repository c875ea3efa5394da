"""Seeded synthetic interactions and catalogs.

Every value is drawn from the MD5 of the seed and the row number, not from a task's random stream:
the same rows come out however many tasks make them, and again when a task is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: domains of the generated data --------------------------------
USERS, ITEMS = 200, 500
FIRST_TIME, STEP_SECONDS = "2024-01-01 00:00:00", 1800
EVENT_SHARES = [("purchase", 0.25), ("view", 0.50), ("wishlist", 0.15), ("cart", 0.10)]
CATEGORIES = ["electronics", "clothing", "home", "books", "sports", "beauty"]
BRANDS = ["BrandA", "BrandB", "BrandC", "BrandD", "BrandE"]
INTERACTION_SEED, PRODUCT_SEED = 42, 0
# --- end of fixed values -----------------------------------------------------------


def row_numbers(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "row")


def _draws(seed: int, salt: str = "") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{salt}"), F.col("row").cast("string")))


def _uniform(digest: Column, part: int) -> Column:
    """The part-th eight hex digits of a digest as a number in [0, 1)."""
    digits = F.substring(digest, 8 * part + 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def _whole(draw: Column, low: int, count: int) -> Column:
    return (F.floor(draw * count) + low).cast("long")


def _pick(draw: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(draw * len(values)) + 1).cast("int"))


def generate_interactions(rows: DataFrame, seed: int = INTERACTION_SEED) -> DataFrame:
    """Interactions for the row numbers (`row`, from 0): uniform users, items and ratings, one every
    half hour, event types by their shares."""
    drawn = rows.select("row", _draws(seed).alias("d"))
    event, reached = F.lit(EVENT_SHARES[-1][0]), []
    total = 0.0
    for name, share in EVENT_SHARES[:-1]:
        total += share
        reached.append((name, total))
    for name, bound in reversed(reached):
        event = F.when(_uniform(F.col("d"), 3) < bound, name).otherwise(event)
    start = F.unix_timestamp(F.lit(FIRST_TIME))
    return drawn.select(
        _whole(_uniform(F.col("d"), 0), 1, USERS).alias("user_id"),
        _whole(_uniform(F.col("d"), 1), 1, ITEMS).alias("item_id"),
        F.round(_uniform(F.col("d"), 2) * 4.0 + 1.0, 1).alias("rating"),
        F.date_format(
            F.timestamp_seconds(start + F.col("row") * STEP_SECONDS), "yyyy-MM-dd HH:mm:ss"
        ).alias("timestamp"),
        event.alias("event_type"),
    )


def generate_products(rows: DataFrame, seed: int = PRODUCT_SEED) -> DataFrame:
    """A catalog entry per row number."""
    drawn = rows.select("row", _draws(seed).alias("d"), _draws(seed, "b").alias("e"))
    d, e = F.col("d"), F.col("e")
    return drawn.select(
        (F.col("row") + 1).alias("item_id"),
        F.concat(F.lit("Product_"), (F.col("row") + 1).cast("string")).alias("title"),
        _pick(_uniform(d, 0), CATEGORIES).alias("category"),
        _pick(_uniform(d, 1), BRANDS).alias("brand"),
        F.round(_uniform(d, 2) * 994.0 + 5.0, 2).alias("price"),
        F.round(_uniform(d, 3) * 4.0 + 1.0, 1).alias("rating"),
        _whole(_uniform(e, 0), 5, 4995).cast("int").alias("rating_count"),
        (_uniform(e, 1) < 0.85).alias("in_stock"),
    )
