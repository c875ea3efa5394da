"""Snapshot and feature-table sinks."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.schemas import FEATURE_TABLES
from affinis.session import drop_folder


def snapshot_name() -> str:
    return datetime.now(timezone.utc).strftime("s%Y%m%d_%H%M%S_%f")


def _append(df: DataFrame, path: str, fmt: str, ingest_ts: str | None) -> str:
    name = ingest_ts or snapshot_name()
    stamped = df.withColumn("ingest_ts", F.lit(name))
    writer = stamped.write.mode("append").partitionBy("ingest_ts")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return name


def write_raw_snapshot(
    df: DataFrame, path: str, fmt: str = "csv", ingest_ts: str | None = None
) -> str:
    """Append a raw copy under its own `ingest_ts` partition; returns the partition's name."""
    return _append(df, path, fmt, ingest_ts)


def write_processed_snapshot(
    df: DataFrame, root: str, name: str, ingest_ts: str | None = None
) -> str:
    """Append a processed table as Parquet below `root/name`."""
    return _append(df, f"{root}/{name}", "parquet", ingest_ts)


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1")


def write_feature_tables(
    tables: dict[str, DataFrame], root: str, check_keys: bool = True
) -> None:
    """Replace feature tables, cast to their declared schema; duplicate keys are an error.

    Each table is computed once, written beside the old one and checked there (key columns only); it replaces the old
    one when the check has passed, so a failure leaves the old table.
    """
    for name, df in tables.items():
        schema, keys = FEATURE_TABLES[name]
        declared = [
            F.col(f.name).cast(f.dataType) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
        spark, path, staged = df.sparkSession, f"{root}/{name}", f"{root}/_staged-{name}-{uuid.uuid4().hex}"
        df.select(*declared).write.parquet(staged)
        if check_keys and not duplicated_keys(spark.read.parquet(staged), keys).isEmpty():
            drop_folder(spark, staged)
            raise ValueError(f"{name}: {keys} is not unique")
        drop_folder(spark, path)
        paths = spark._jvm.org.apache.hadoop.fs
        source = paths.Path(staged)
        if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, paths.Path(path)):
            raise OSError(f"{staged} could not be moved to {path}")
