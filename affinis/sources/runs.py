"""Training runs as a table with parameter, metric and tag maps."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.functions.columns import half_even

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("experiment", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("params", _TEXT_MAP),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", _TEXT_MAP),
    ]
)


def start_time() -> str:
    return datetime.now(timezone.utc).isoformat()


def log_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    metrics: DataFrame | dict[str, float],
    params: dict | None = None,
    tags: dict | None = None,
    status: str = "FINISHED",
    started: str | None = None,
) -> str:
    """Append one run. Metrics come as a dict or as the columns of a one-row table; six decimals."""
    now = start_time()
    started = started or now
    run_id = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f") + "_" + uuid.uuid4().hex[:6]
    if isinstance(metrics, dict):
        fields = ", ".join(f"`{k}` DOUBLE" for k in metrics)
        values = tuple(float(v) for v in metrics.values())
        metrics = spark.createDataFrame([values], fields) if metrics else spark.range(1).select()
    pairs = [
        part
        for c in metrics.columns
        for part in (F.lit(c), half_even(F.col(f"`{c}`").cast("double"), 6))
    ]

    def text_map(values: dict | None):
        items = [F.lit(str(part)) for pair in (values or {}).items() for part in pair]
        return (F.create_map(*items) if items else F.create_map()).cast(_TEXT_MAP)

    row = metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(experiment).alias("experiment"),
        F.lit(status).alias("status"),
        F.lit(started).alias("start_time"),
        F.lit(now).alias("end_time"),
        text_map(params).alias("params"),
        F.create_map(*pairs).cast("map<string,double>").alias("metrics"),
        text_map(tags).alias("tags"),
    )
    row.write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(RUNS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUNS)


def compare_runs(runs: DataFrame) -> DataFrame:
    """Per experiment and metric: number of runs, latest and best value, and the best run."""
    values = runs.select(
        "experiment", "run_id", "start_time", F.explode("metrics").alias("metric", "value")
    )
    return values.groupBy("experiment", "metric").agg(
        F.count(F.lit(1)).alias("runs"),
        F.max_by("value", F.struct("start_time", "run_id")).alias("latest_value"),
        F.max("value").alias("best_value"),
        F.max_by("run_id", F.struct("value", "start_time")).alias("best_run"),
    )
