"""Label codes and min-max scaling, fitted to tables that apply to new data as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.ordering import HOT_ROWS, with_position
from affinis.session import pin


def _label(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def fit_labels(df: DataFrame, column: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(value, code) for the distinct values in text order; null is the value 'nan'.

    The distinct values are written once, so applying the codes does not read the table again.
    """
    values = pin(df.select(_label(column).alias("value")).distinct())
    return with_position(values, ["value"], "code", hot_rows)


def apply_labels(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """Add `<column>_encoded`; values unknown to `labels` give null."""
    codes = labels.select(F.col("value").alias("_label"), F.col("code").alias(f"{column}_encoded"))
    return df.withColumn("_label", _label(column)).join(codes, "_label", "left").drop("_label")


def label_encode(df: DataFrame, column: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    if column not in df.columns:
        return df
    return apply_labels(df, column, fit_labels(df, column, hot_rows))


def fit_min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def apply_min_max(df: DataFrame, column: str, scale: DataFrame, out: str) -> DataFrame:
    """(x - low) / (high - low); a constant column gives 0."""
    bounds = scale.select(F.struct("low", "high")).scalar()
    span = bounds["high"] - bounds["low"]
    scaled = (F.col(column) - bounds["low"]) / F.when(span == 0, F.lit(1.0)).otherwise(span)
    return df.withColumn(out, scaled)


def min_max_scale(df: DataFrame, column: str = "price", out: str = "price_normalized") -> DataFrame:
    return apply_min_max(df, column, fit_min_max(df, column), out)


def encode_products(
    df: DataFrame, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Coded category and brand, scaled price, and the fitted tables.

    Fitting and applying read `df` several times: give a written or pinned table.
    """
    encoders: dict[str, DataFrame] = {}
    out = df
    for column in ("category", "brand"):
        if column in df.columns:
            encoders[column] = fit_labels(df, column, hot_rows)
            out = apply_labels(out, column, encoders[column])
    encoders["price_scaler"] = fit_min_max(df, "price")
    return apply_min_max(out, "price", encoders["price_scaler"], "price_normalized"), encoders


def transform_products(df: DataFrame, encoders: dict[str, DataFrame]) -> DataFrame:
    """Apply encoders fitted earlier to another catalog."""
    out = df
    for column, fitted in encoders.items():
        if column == "price_scaler":
            out = apply_min_max(out, "price", fitted, "price_normalized")
        elif column in df.columns:
            out = apply_labels(out, column, fitted)
    return out
