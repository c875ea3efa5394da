"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "affinis", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator relies on.

    Cluster sizing (executors, shuffle partitions, checkpoint folder) stays with
    spark-submit; only what results or plans depend on is set here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # The call-site capture costs milliseconds per column expression when plans are built.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors this package, wherever the driver was started."""
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="affinis-package-"), "affinis.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="affinis-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder name below the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def pin(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Write `df` once to reliable storage; later uses see the very same rows.

    Parquet keeps column pruning, pushed filters and size statistics for what reads it afterwards. Where the caller knows
    how many rows the last step can meet, `tasks` keeps it from being dealt to more tasks, each of which writes a file.
    """
    if tasks is not None:
        df = df.coalesce(max(1, tasks))
    path = scratch_dir(df.sparkSession, "pin")
    df.write.parquet(path)
    pinned = df.sparkSession.read.schema(df.schema).parquet(path)
    pinned._pinned_at = path
    return pinned


def unpin(*frames: DataFrame) -> None:
    """Remove the folders of pinned tables once nothing lazy reads them any more."""
    for df in frames:
        drop_folder(df.sparkSession, df._pinned_at)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps: it does so once the driver has collected their plans."""
    gc.collect()
    spark._jvm.System.gc()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
