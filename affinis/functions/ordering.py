"""Positions, running totals and exact quantiles that survive hot groups.

Small inputs use the plain window or aggregate. Groups beyond `hot_rows` rows are spread
by range partitioning over (group, order), so no task ever holds such a group whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.session import pin

# Most rows of one group, or of one unpartitioned window, that a single task may take.
HOT_ROWS = 5_000_000


def fresh(name: str, df: DataFrame) -> str:
    """`name`, with underscores put in front until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fits_one_task(df: DataFrame, hot_rows: int = HOT_ROWS) -> bool:
    return df.count() <= hot_rows


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of groups above `hot_rows` (None when there are none).

    There can be at most rows / hot_rows hot groups (200 for a billion rows, 200,000 for 10^12),
    which bounds the broadcast list of their keys.
    """
    if fits_one_task(df.select(*keys), hot_rows):
        return df, None
    sizes = df.groupBy(*keys).count()
    hot = pin(sizes.filter(F.col("count") > hot_rows).select(*keys))
    if hot.isEmpty():
        return df, None
    return (
        df.join(F.broadcast(hot), list(keys), "left_anti"),
        df.join(F.broadcast(hot), list(keys), "left_semi"),
    )


def with_running_total(
    df: DataFrame, order: Sequence[str | Column], weight: Column, out: str
) -> DataFrame:
    """Add `out`: the total weight of all rows before this one; `order` must be total.

    Range partitioning gives ordered slices; each slice adds up its own rows and starts from
    the total of the slices before it. The sliced table is pinned because the slice bounds are
    sampled: recomputing them could move rows between slices.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = pin(df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()))
    before_slice = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("_slice")
        .agg(F.sum(weight).alias("_total"))
        .select("_slice", F.coalesce(F.sum("_total").over(before_slice), F.lit(0)).alias("_start"))
    )
    in_slice = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    # `starts` has one row per slice, a number set by configuration.
    return (
        sliced.withColumn("_inside", F.coalesce(F.sum(weight).over(in_slice), F.lit(0)))
        .join(F.broadcast(starts), "_slice")
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_slice", "_start", "_inside")
    )


def numbered(df: DataFrame, order: Sequence[str | Column], out: str) -> DataFrame:
    """Add the 0-based position of each row in one order over the whole table, which is read as a written one.

    One range shuffle; every slice is written in order, so a row's place in its slice is its place in the file and no second
    shuffle follows. Slices start at the sizes of those before them (one row a slice). Ties are numbered in any order.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = fresh("place", df)
    sliced = pin(
        df.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id())
    )
    # monotonically_increasing_id() is the partition in the upper bits and the row of it in the lower 33.
    number, row = F.shiftright(place, 33), F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    number_name, start = fresh("slice", df), fresh("start", df)
    starts = (
        sliced.groupBy(number.alias(number_name))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            number_name,
            F.coalesce(F.sum("n").over(W.orderBy(number_name).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(start),
        )
    )
    return (
        sliced.withColumn(number_name, number)
        .join(F.broadcast(starts), number_name)  # one row a slice, a number set by configuration
        .withColumn(out, F.col(start) + row)
        .select(*df.columns, out)
    )


def with_position(
    df: DataFrame, order: Sequence[str | Column], out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the 0-based position of each row in one order over the whole table."""
    if fits_one_task(df, hot_rows):
        return df.withColumn(out, (F.row_number().over(W.orderBy(*order)) - 1).cast("long"))
    return with_running_total(df, order, F.lit(1), out)


def with_group_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    out: str,
    size: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the 0-based position within the group and the group's row count."""
    keys = list(keys)
    rest, hot = split_hot(df, keys, hot_rows)
    group = W.partitionBy(*keys)
    plain = rest.withColumn(
        out, (F.row_number().over(group.orderBy(*order)) - 1).cast("long")
    ).withColumn(size, F.count(F.lit(1)).over(group))
    if hot is None:
        return plain
    running = with_running_total(hot, [*keys, *order], F.lit(1), "_at")
    spans = running.groupBy(*keys).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias(size)
    )
    spread = (
        running.join(F.broadcast(spans), keys)  # one row per hot group
        .withColumn(out, F.col("_at") - F.col("_first"))
        .select(*plain.columns)
    )
    return plain.unionByName(spread)


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    points: dict[str, float],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact, linearly interpolated quantiles of `value` per group (nulls ignored).

    `points` maps output names to fractions. Larger inputs are first reduced to (group, value)
    counts, a grouping that no hot group can unbalance.
    """
    keys = list(keys)
    present = df.select(*keys, value).filter(F.col(value).isNotNull())
    if fits_one_task(present, hot_rows):
        return _named(present.groupBy(*keys), F.percentile(value, _fractions(points)), points, keys)
    counts = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return weighted_quantiles(pin(counts), keys, value, "_n", points, hot_rows)


def weighted_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    points: dict[str, float],
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """`quantiles` of a table that holds each (group, value) with its number of rows.

    Groups with more than `hot_rows` different values are walked by running totals. `small` says
    that the caller has already checked the whole table to be below that.
    """
    keys = list(keys)
    present = counts.select(*keys, value, F.col(weight).alias("_n")).filter(F.col(value).isNotNull())

    def direct(part: DataFrame) -> DataFrame:
        picked = F.percentile(value, _fractions(points), F.col("_n"))
        return _named(part.groupBy(*keys), picked, points, keys)

    if small:
        return direct(present)
    if not keys:
        if fits_one_task(present, hot_rows):
            return direct(present)
        merged = present.groupBy(value).agg(F.sum("_n").alias("_n"))
        return _walked_quantiles(merged, keys, value, points)
    rest, hot = split_hot(present, keys, hot_rows)
    if hot is None:
        return direct(rest)
    return direct(rest).unionByName(_walked_quantiles(hot, keys, value, points))


def _fractions(points: dict[str, float]) -> Column:
    return F.array(*[F.lit(float(f)) for f in points.values()])


def _named(grouped, picked: Column, points: dict[str, float], keys: list[str]) -> DataFrame:
    return grouped.agg(picked.alias("_q")).select(
        *keys, *[F.col("_q")[i].alias(name) for i, name in enumerate(points)]
    )


def _walked_quantiles(
    counts: DataFrame, keys: list[str], value: str, points: dict[str, float]
) -> DataFrame:
    running = with_running_total(counts, [*keys, value], F.col("_n"), "_at")
    if not keys:
        running = running.withColumn("_all", F.lit(1))
    group = keys or ["_all"]
    spans = running.groupBy(*group).agg(
        F.min("_at").alias("_first"), F.sum("_n").alias("_rows")
    )
    walked = running.join(F.broadcast(spans), group).withColumn("_from", F.col("_at") - F.col("_first"))

    def at(index: Column) -> Column:
        holds = (F.col("_from") <= index) & (index < F.col("_from") + F.col("_n"))
        return F.max(F.when(holds, F.col(value)))

    picks = []
    for i, fraction in enumerate(points.values()):
        place = (F.col("_rows") - 1) * F.lit(float(fraction))
        picks += [
            at(F.floor(place)).alias(f"_lo{i}"),
            at(F.ceil(place)).alias(f"_hi{i}"),
            F.max(place - F.floor(place)).alias(f"_w{i}"),
        ]
    return walked.groupBy(*group).agg(*picks).select(
        *keys,
        *[
            ((1 - F.col(f"_w{i}")) * F.col(f"_lo{i}") + F.col(f"_w{i}") * F.col(f"_hi{i}")).alias(name)
            for i, name in enumerate(points)
        ],
    )
