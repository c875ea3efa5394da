"""Membership joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A list up to this length travels in the plan and is pushed into the scan.
LIST_LIMIT = 1_000


def semi_join_entities(df: DataFrame, key: str, ids: Sequence | DataFrame) -> DataFrame:
    """Rows whose key is among `ids`, a list of values or a one-column table."""
    if isinstance(ids, DataFrame):
        return df.join(ids.toDF(key), key, "left_semi")
    if len(ids) <= LIST_LIMIT:
        return df.filter(F.col(key).isin(list(ids)))
    spark = df.sparkSession
    table = spark.createDataFrame([(v,) for v in ids], f"{key} {df.schema[key].dataType.simpleString()}")
    return df.join(table, key, "left_semi")


def anti_join_seen(recommended: DataFrame, ratings: DataFrame) -> DataFrame:
    """Recommendations without the items the user has already rated above zero."""
    seen = ratings.filter(F.col("rating") > 0).select("user_id", "item_id")
    return recommended.join(seen, ["user_id", "item_id"], "left_anti")
