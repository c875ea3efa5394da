"""Typed reads of landed files and of timestamped snapshots."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.functions.columns import nan_to_null
from affinis.schemas import INTERACTIONS_RAW
from affinis.session import pin

CORRUPT, REASON = "_corrupt_record", "_reject_reason"
REQUIRED = ("user_id", "item_id", "rating", "timestamp")
MANY_FILES = 100_000  # headers of more files are joined by a shuffle
MANY_HEADERS = 200  # different first lines of one batch of files
MAX_TEXT = 2**31 - 1


# What a cast can accept at all: a cast that fails costs many times one that does not.
_BLANK, _DIGITS = r"[\s\p{Cc}]*", r"[\p{Nd}.]+(e[+-]?\p{Nd}+)?"
WHOLE = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
DECIMAL = rf"(?i)^{_BLANK}[+-]?{_DIGITS}{_BLANK}$"
FLOATING = rf"(?i)^{_BLANK}[+-]?({_DIGITS}[df]?|0x[0-9a-f.]+p[+-]?[0-9]+[df]?|nan|inf(inity)?){_BLANK}$"


def _typed(text: Column, kind: T.DataType) -> Column:
    """A field as its column type, null where it does not fit; whole numbers may be written as decimals (`1.0`)."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.LongType, T.IntegerType)):
        number = text.try_cast("decimal(38,6)")
        written = F.when(number == F.floor(number), number.try_cast(kind))
        return F.coalesce(F.when(text.rlike(WHOLE), text.try_cast(kind)), F.when(text.rlike(DECIMAL), written))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(text.rlike(FLOATING), text.try_cast(kind))
    return text.try_cast(kind)


def _headers(lines: DataFrame) -> DataFrame:
    """`file` and its first line; only the first blocks of files count."""
    first = lines.filter(F.col("start") == 0).groupBy("file").agg(F.min_by("value", "row").alias("header"))
    return first.select("file", "header")


def scan_interactions(
    spark: SparkSession, path: str, schema: T.StructType = INTERACTIONS_RAW, required: Sequence[str] = REQUIRED
) -> DataFrame:
    """CSV files with headers of their own, typed by column name.

    Every file's first line says where its columns are: their order may differ from file to file, columns beyond `schema` are
    ignored, and those that a file lacks are null, unless `required`: that is an error. A line whose fields do not fit keeps its text
    in `_corrupt_record` and what is wrong in `_reject_reason` (see `accepted`, `rejected`). Empty and NaN fields are null. Quoted
    fields may hold commas but no line ends. The files are read as text twice: once for their headers, once for their rows.
    """
    text = spark.read.text(path).select(
        F.when(F.col("value").startswith("\ufeff"), F.substring("value", 2, MAX_TEXT)).otherwise(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    headers = pin(_headers(text.filter(F.trim("value") != "").withColumn("row", F.monotonically_increasing_id())))
    shapes = [r["header"] for r in headers.select("header").distinct().orderBy("header").limit(MANY_HEADERS + 1).collect()]
    if len(shapes) > MANY_HEADERS:
        raise ValueError(f"more than {MANY_HEADERS} different headers below {path}: the files seem to have none")
    names = [[n.strip() for n in next(csv.reader([line]))] for line in shapes]
    for line, found in zip(shapes, names):
        missing = [c for c in required if c not in found]
        if missing:
            raise ValueError(f"a file with the header {line!r} lacks the columns {missing}")
    few = headers.count() <= MANY_FILES
    lines = text.join(F.broadcast(headers) if few else headers, "file").filter(
        (F.trim("value") != "") & ((F.col("start") > 0) | (F.col("value") != F.col("header")))
    )

    if not shapes:
        extra = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType()), T.StructField(REASON, T.StringType())])
        return spark.createDataFrame([], extra)

    def parsed(width: int) -> Column:
        """The fields as text, and the line itself if it has not as many."""
        ddl = ", ".join(f"c{k} STRING" for k in range(width)) + f", {CORRUPT} STRING"
        return F.from_csv("value", ddl, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})

    # A column for each number of fields: a line is parsed once, and its columns are picked from that by its header. The generator
    # of one row keeps conditions on the columns from being moved below, where every use of a column would parse the line again.
    by_width: dict[int, list[int]] = {}
    for k, found in enumerate(names):
        by_width.setdefault(len(found), []).append(k)
    shape = F.array_position(F.array(*[F.lit(line) for line in shapes]), F.col("header")) - 1
    of_width = {w: F.when(F.col("shape").isin(ks), parsed(w)).alias(f"w{w}") for w, ks in by_width.items()}
    once = F.explode(F.array(F.struct(*of_width.values()))).alias("p")
    split = lines.select("value", shape.alias("shape")).select("value", "shape", once)

    def field(name: str) -> Column:
        at: dict[tuple[int, int], list[int]] = {}
        for k, found in enumerate(names):
            if name in found:
                at.setdefault((len(found), found.index(name)), []).append(k)
        picked = [F.when(F.col("shape").isin(ks), F.col(f"p.w{w}")[f"c{c}"]) for (w, c), ks in at.items()]
        return F.coalesce(*picked, F.lit(None).cast("string")).alias(name)

    refused = F.coalesce(*[F.col(f"p.w{w}")[CORRUPT] for w in by_width]).alias(CORRUPT)
    row = split.select("value", F.struct(*[field(f.name) for f in schema], refused).alias("f"))
    wrong = [
        F.when(F.col(f"f.{f.name}").isNotNull() & _typed(F.col(f"f.{f.name}"), f.dataType).isNull(), F.lit(f.name)) for f in schema
    ]
    reason = F.when(F.col(f"f.{CORRUPT}").isNotNull(), F.lit("fields")).otherwise(F.nullif(F.concat_ws(",", *wrong), F.lit("")))
    typed = row.select(
        *[_typed(F.col(f"f.{f.name}"), f.dataType).alias(f.name) for f in schema], "value", reason.alias(REASON)
    )
    return nan_to_null(
        typed.select(*[f.name for f in schema], F.when(F.col(REASON).isNotNull(), F.col("value")).alias(CORRUPT), REASON)
    )


def accepted(read: DataFrame) -> DataFrame:
    return read.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, REASON)


def rejected(read: DataFrame) -> DataFrame:
    """Lines that do not fit: the line and the columns at fault (`fields`: not as many fields as the header)."""
    return read.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, REASON)


def reject_counts(read: DataFrame) -> DataFrame:
    """reason, lines: how many lines were refused for what."""
    return rejected(read).groupBy(F.col(REASON).alias("reason")).agg(F.count(F.lit(1)).alias("lines"))


# Every field is read as text, because sources disagree on shapes.
_PRODUCT_TEXT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "id", "item_id", "title", "category", "brand", "price", "rating", "rating_count", "in_stock",
        )
    ]
)


def normalize_products(read: DataFrame) -> DataFrame:
    """One catalog schema from either shape: `id` or `item_id`, rating object or number.

    Absent fields get the catalog defaults; a value that cannot be read becomes null and is left to
    the quality rules.
    """
    nested = F.ltrim("rating").startswith("{")

    def number(text: Column, kind: str, default) -> Column:
        return F.when(text.isNull(), F.lit(default)).otherwise(text.try_cast(kind))

    rate = F.when(nested, F.get_json_object("rating", "$.rate").try_cast("double")).otherwise(
        number(F.col("rating"), "double", 0.0)
    )
    count = F.when(
        nested, F.coalesce(F.get_json_object("rating", "$.count"), "rating_count", F.lit("0"))
    ).otherwise(F.coalesce("rating_count", F.lit("0")))
    return nan_to_null(
        read.select(
            F.coalesce("id", "item_id").try_cast("long").alias("item_id"),
            F.coalesce("title", F.lit("")).alias("title"),
            F.coalesce("category", F.lit("unknown")).alias("category"),
            F.coalesce("brand", F.lit("unknown")).alias("brand"),
            number(F.col("price"), "double", 0.0).alias("price"),
            rate.alias("rating"),
            count.try_cast("int").alias("rating_count"),
            number(F.col("in_stock"), "boolean", True).alias("in_stock"),
        )
    )


def scan_products_json(spark: SparkSession, path: str, arrays: bool = False) -> DataFrame:
    """Catalog records, one JSON object per line, or (`arrays`) one array per file.

    Lines split over tasks; a file holding one array is read by a single task, so large catalogs
    should land as lines or as many pages.
    """
    return normalize_products(spark.read.schema(_PRODUCT_TEXT).option("multiLine", arrays).json(path))


def scan_latest_snapshot(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """The newest `ingest_ts` partition of a snapshot table, found by folder names; only its files are listed and read."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("ingest_ts", T.StringType())]))
    if fmt == "csv":
        reader = reader.option("header", True)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in listed if f.isDirectory() and f.getPath().getName().startswith("ingest_ts=")]
    if not names:
        raise FileNotFoundError(f"no snapshot below {path}")
    return reader.option("basePath", path).load(f"{path}/{max(names)}")


def read_feature_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")
