"""Time-ordered sequences and the per-user hold-out split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.ordering import HOT_ROWS, with_group_position


def sequence_in_user(
    df: DataFrame,
    order: Sequence[str] = ("timestamp",),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `seq_in_user` (from 0) and `user_total`. `order` should be total within a user."""
    known = df.filter(F.col("user_id").isNotNull())
    return with_group_position(
        known, ["user_id"], list(order), "seq_in_user", "user_total", hot_rows
    )


def temporal_holdout_split(
    df: DataFrame,
    order: Sequence[str] = ("timestamp",),
    train_percent: int = 80,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `is_test`: the last part of each user's rows in time, one row alone being test."""
    placed = sequence_in_user(df, order, hot_rows)
    kept = F.floor(F.col("user_total") * train_percent / 100)
    return placed.withColumn("is_test", F.col("seq_in_user") >= kept).drop(
        "seq_in_user", "user_total"
    )
