"""One row per key.

A `row_number() = 1` filter lets Spark cut each key to one row before the shuffle (window group
limit), so a key holding a large share of the table never arrives whole at one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def dedup_keep_latest(
    df: DataFrame,
    keys: Sequence[str] = ("user_id", "item_id"),
    time: str = "timestamp",
    tiebreak: Sequence[str] = (),
    parse_first: bool = False,
) -> DataFrame:
    """Keep the last row per key in time order.

    The time column is compared as it comes, with nulls last: a missing or unreadable text
    therefore wins its key (and is dropped when timestamps are parsed afterwards).
    `parse_first=True` compares parsed times instead and prefers any valid one.
    """
    if parse_first:
        newest = F.try_to_timestamp(F.col(time).cast("string")).desc_nulls_last()
    else:
        newest = F.col(time).desc_nulls_first()
    return _keep_one(df, keys, [newest, *[F.col(c).desc() for c in tiebreak]])


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by an explicit input order."""
    return _keep_one(df, keys, [F.col(c).asc() for c in order])
