"""Checks made when a table is ingested."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.schemas import REQUIRED_INTERACTION_COLUMNS


def missing_columns(
    df: DataFrame, required: Sequence[str] = tuple(REQUIRED_INTERACTION_COLUMNS)
) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(
    df: DataFrame, required: Sequence[str] = tuple(REQUIRED_INTERACTION_COLUMNS)
) -> DataFrame:
    """(required_column, present, non_null) for each required column; accept if all present."""
    counted = df.agg(
        *[
            (F.count(c) if c in df.columns else F.sum(F.lit(0))).alias(f"n_{i}")
            for i, c in enumerate(required)
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("required_column"),
            F.lit(c in df.columns).alias("present"),
            F.coalesce(F.col(f"n_{i}"), F.lit(0)).cast("long").alias("non_null"),
        )
        for i, c in enumerate(required)
    ]
    return counted.select(F.inline(F.array(*rows)))


def null_counts(
    df: DataFrame, columns: Sequence[str] = tuple(REQUIRED_INTERACTION_COLUMNS)
) -> DataFrame:
    """One row: nulls over the given columns."""
    per_column = [F.count_if(F.col(c).isNull()) for c in columns]
    return df.agg(sum(per_column[1:], per_column[0]).alias("null_count"))


def duplicate_key_count(
    df: DataFrame, keys: Sequence[str] = ("user_id", "item_id", "timestamp")
) -> DataFrame:
    """One row: rows beyond the first of each key; nulls are equal."""
    groups = df.groupBy(*keys).count()
    return groups.agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_count")
    )


def row_hash_columns(df: DataFrame):
    """Aggregates that identify a table's content whatever the order of its rows.

    The hash skips nulls, so which columns are null is hashed with the values.
    """
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in df.columns])
    row = F.xxhash64(nulls, *df.columns)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("hash_xor"),
        # high and low halves apart, so the sums cannot overflow
        F.coalesce(F.sum(F.shiftright(row, 32)), F.lit(0)).alias("hash_high"),
        F.coalesce(F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0)).alias("hash_low"),
    ]


def table_checksum(df: DataFrame, method: str = "xxhash64") -> DataFrame:
    """One row: row count and an order-insensitive digest (row order has no meaning here).

    `md5` hashes a text form of each row, for comparison with other engines: each value with its length in
    front, a null as `-`, so no two rows share a text.
    """
    if method == "xxhash64":
        return df.agg(*row_hash_columns(df)).select(
            "rows",
            F.md5(F.concat_ws(":", "rows", "hash_xor", "hash_high", "hash_low")).alias("checksum"),
        )
    values = [F.col(c).cast("string") for c in df.columns]
    text = F.concat(*[F.coalesce(F.concat(F.length(v), F.lit(":"), v), F.lit("-")) for v in values])
    prefix = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.select(prefix.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("h"), F.lit(0)).alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
    )
