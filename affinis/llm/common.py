"""What the training-data operators share: words, row identity, fresh names, table access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, and ASCII letters.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text, split at ASCII white space; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def fresh(name: str, *frames: DataFrame) -> str:
    """`name`, with underscores put in front until no given frame has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(id_col: Column, text: Column) -> list[Column]:
    """Two longs that identify a row by id and text, null id and null text included.

    Rows equal in both are one document repeated; operators treat every copy alike.
    """
    mark = F.xxhash64(F.isnull(id_col), F.isnull(text), id_col.cast("long"), text)
    return [F.coalesce(id_col.cast("long"), F.lit(0)).alias("key_id"), mark.alias("key_mark")]


def attach(rows: DataFrame, facts: DataFrame, key: str, weight: str, share: int = 1_000) -> DataFrame:
    """`rows` with the columns of `facts`, one row a key (nulls are a key), whose `weight` is the key's number of rows.

    Keys that hold a `share`th of all rows or more, at most `share` by that, are joined by broadcast and never meet in a
    task; the others go through a shuffle. Both tables are read twice: give written ones.
    """
    total = facts.agg(F.sum(weight)).scalar()
    mark, name = fresh("attached", rows, facts), fresh("fact_key", rows, facts)
    renamed = facts.withColumnRenamed(key, name)
    is_hot = F.col(weight) * share >= total
    same = F.col(key).eqNullSafe(F.col(name))
    hot = renamed.filter(is_hot).withColumn(mark, F.lit(True))
    flagged = rows.join(F.broadcast(hot), same, "left")
    near = flagged.filter(F.col(mark))
    far = flagged.filter(F.col(mark).isNull()).select(*rows.columns).join(renamed.filter(~is_hot), same)
    return near.drop(mark, name).unionByName(far.drop(name))
