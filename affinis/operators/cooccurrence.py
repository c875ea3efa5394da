"""Item pairs that share users, and their Jaccard similarity.

Enumerating the pairs of a basket costs its size squared, so three things keep that bounded while
the result stays exact:

* items with fewer users than the threshold cannot reach it and go before any pair is formed;
* the few widest baskets never enumerate. Each gets one bit, every item the mask of the wide
  baskets holding it. `bit_count(mask_a & mask_b)` completes the counts of pairs seen elsewhere,
  and pairs seen only in wide baskets are formed only when that count alone reaches the threshold,
  so each of them is a row of the result;
* other large baskets are cut into tiles of bounded size, one join key per pair of tiles.

A table of baskets is small beside its pairs, so the number of tasks follows the pairs, which are known from the basket sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinis.functions.columns import half_even
from affinis.session import pin

TILE_ITEMS = 2_000
WIDE_BASKET = 20_000
MAX_WIDE = 12  # bits, hence at most 4096 different masks
PAIRS_A_TASK, FEW_PAIRS = 1 << 22, 1 << 18  # pairs formed or counted by one task: at most, and worth a task of its own


def _baskets(df: DataFrame) -> DataFrame:
    known = F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
    return df.filter(known).select("user_id", "item_id").distinct()


def _with_support(baskets: DataFrame, min_cooccur: int) -> tuple[DataFrame, DataFrame]:
    """Baskets without the items that too few users hold, and the user count per kept item."""
    degrees = (
        baskets.groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("degree"))
        .filter(F.col("degree") >= min_cooccur)
    )
    return baskets.join(degrees.select("item_id"), "item_id", "left_semi"), degrees


def _pairs_within(baskets: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    dealt = baskets.repartition(tasks, *keys)
    left = dealt.select(*keys, F.col("item_id").alias("item_a"))
    right = dealt.select(*keys, F.col("item_id").alias("item_b"))
    return left.join(right, keys).filter("item_a < item_b")


def _tile_of(item: Column | str, tiles: Column) -> Column:
    return F.pmod(F.xxhash64(item), tiles)


def _tiled_pairs(baskets: DataFrame, sizes: DataFrame, tile_items: int, tasks: int) -> DataFrame:
    """All pairs of each basket, joined per (user, tile of a, tile of b)."""
    placed = (
        baskets.join(sizes, "user_id")
        .withColumn("_tiles", F.ceil(F.col("size") / tile_items))
        .withColumn("_own", _tile_of("item_id", F.col("_tiles")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)))
    )
    left = placed.select(
        "user_id",
        F.col("_own").alias("_ta"),
        F.col("_other").alias("_tb"),
        F.col("item_id").alias("item_a"),
    )
    right = placed.select(
        "user_id",
        F.col("_other").alias("_ta"),
        F.col("_own").alias("_tb"),
        F.col("item_id").alias("item_b"),
    )
    keys = ["user_id", "_ta", "_tb"]
    return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys).filter("item_a < item_b")


def _counted(pairs: DataFrame, n_pairs: int, n_items: int) -> DataFrame:
    """Pairs that repeat much are counted before the shuffle; so many that few repeat in a task, by tasks of bounded size."""
    spread = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if min(n_pairs, n_items * (n_items - 1) // 2) > spread * PAIRS_A_TASK:
        pairs = pairs.repartition(-(-n_pairs // PAIRS_A_TASK), "item_a", "item_b")
    return pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("cooccur_count"))


def _wide_masks(baskets: DataFrame, wide: DataFrame) -> DataFrame:
    """(item_id, mask): one bit per wide basket that holds the item."""
    bits = wide.select(
        "user_id", F.expr("shiftleft(1L, row_number() OVER (ORDER BY user_id) - 1)").alias("bit")
    )  # at most MAX_WIDE rows
    return (
        baskets.join(F.broadcast(bits), "user_id")
        .groupBy("item_id")
        .agg(F.sum("bit").alias("mask"))
    )


def _wide_only_pairs(masks: DataFrame, min_cooccur: int, tile_items: int) -> DataFrame:
    """Pairs held together by at least `min_cooccur` wide baskets.

    Every item looks up the mask classes it overlaps enough with; each class is cut into tiles, so
    a join key holds a bounded piece of one class.
    """
    shared = masks.filter(F.bit_count("mask") >= min_cooccur)
    classes = shared.groupBy("mask").agg(F.count(F.lit(1)).alias("members"))
    known = classes.agg(
        F.collect_list(F.struct(F.col("mask").alias("klass"), F.col("members"))).alias("classes")
    ).scalar()  # at most 2^MAX_WIDE entries
    tiles = F.ceil(F.col("members") / tile_items)
    right = shared.join(F.broadcast(classes), "mask").select(
        F.col("mask").alias("klass"),
        _tile_of("item_id", tiles).alias("tile"),
        F.col("item_id").alias("item_b"),
    )
    left = (
        shared.select(F.col("item_id").alias("item_a"), "mask", F.inline(known))
        .filter(F.bit_count(F.col("mask").bitwiseAND(F.col("klass"))) >= min_cooccur)
        .withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
        .select("item_a", "mask", "klass", "tile")
    )
    return (
        left.join(right, ["klass", "tile"])
        .filter("item_a < item_b")
        .select(
            "item_a",
            "item_b",
            F.bit_count(F.col("mask").bitwiseAND(F.col("klass"))).cast("long").alias("wide_count"),
        )
    )


def _with_wide(narrow: DataFrame, masks: DataFrame, min_cooccur: int, tile_items: int) -> DataFrame:
    """Complete the counts of the narrow baskets by those of the wide ones."""
    a = masks.select(F.col("item_id").alias("item_a"), F.col("mask").alias("_ma"))
    b = masks.select(F.col("item_id").alias("item_b"), F.col("mask").alias("_mb"))
    common = F.coalesce(F.col("_ma"), F.lit(0)).bitwiseAND(F.coalesce(F.col("_mb"), F.lit(0)))
    seen = narrow.join(a, "item_a", "left").join(b, "item_b", "left")
    completed = seen.select(
        "item_a",
        "item_b",
        (F.col("cooccur_count") + F.bit_count(common)).alias("cooccur_count"),
    )
    # Pairs the wide baskets decide alone; those also seen in narrow ones are complete above.
    alone = _wide_only_pairs(masks, min_cooccur, tile_items).join(
        narrow, ["item_a", "item_b"], "left_anti"
    )
    return completed.unionByName(alone.withColumnRenamed("wide_count", "cooccur_count"))


def _largest_and_pairs(df: DataFrame) -> tuple[int, int]:
    """The rows of the largest basket, and how many pairs all baskets hold at most: one pass over one column."""
    n = F.col("count").cast("decimal(19,0)")
    largest, pairs = df.groupBy("user_id").count().agg(F.max("count"), F.sum(n * (n - 1) / 2)).first()
    return largest or 0, int(pairs or 0)


def _tasks(spark: SparkSession, n_pairs: int) -> int:
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-n_pairs // PAIRS_A_TASK), min(spread, -(-n_pairs // FEW_PAIRS)))


def _cooccurrence(
    baskets: DataFrame, min_cooccur: int, tile_items: int, wide_basket: int, n_items: int
) -> DataFrame:
    enough = F.col("cooccur_count") >= min_cooccur
    sizes = pin(baskets.groupBy("user_id").agg(F.count(F.lit(1)).alias("size")))
    wide = pin(
        sizes.filter(F.col("size") > wide_basket)
        .orderBy(F.desc("size"), "user_id")
        .limit(MAX_WIDE)  # further wide baskets are enumerated in tiles
        .select("user_id")
    )

    def counted(rest: DataFrame) -> DataFrame:
        n_pairs = _largest_and_pairs(rest)[1]
        tiled = _tiled_pairs(rest, sizes, tile_items, _tasks(rest.sparkSession, n_pairs))
        return _counted(tiled, n_pairs, n_items)

    if wide.isEmpty():
        return counted(baskets).filter(enough)
    narrow = pin(counted(baskets.join(F.broadcast(wide), "user_id", "left_anti")))
    masks = pin(_wide_masks(baskets, wide))
    return _with_wide(narrow, masks, min_cooccur, tile_items).filter(enough)


def _pairs_and_degrees(
    df: DataFrame, min_cooccur: int, tile_items: int, wide_basket: int
) -> tuple[DataFrame, DataFrame]:
    baskets, degrees = _with_support(_baskets(df), min_cooccur)
    baskets, degrees = pin(baskets), pin(degrees)
    n_items = degrees.count()
    largest, n_pairs = _largest_and_pairs(baskets)
    if largest <= tile_items:
        pairs = _pairs_within(baskets, ["user_id"], _tasks(df.sparkSession, n_pairs))
        counted = _counted(pairs, n_pairs, n_items)
        return counted.filter(F.col("cooccur_count") >= min_cooccur), degrees
    return _cooccurrence(baskets, min_cooccur, tile_items, wide_basket, n_items), degrees


def item_cooccurrence(
    df: DataFrame,
    min_cooccur: int = 2,
    tile_items: int = TILE_ITEMS,
    wide_basket: int = WIDE_BASKET,
) -> DataFrame:
    """(item_a < item_b, number of users holding both), at least `min_cooccur` users.

    `tile_items` and `wide_basket` only shape the plan; the result does not depend on them.
    """
    return _pairs_and_degrees(df, min_cooccur, tile_items, wide_basket)[0]


def item_jaccard(
    df: DataFrame,
    min_cooccur: int = 2,
    tile_items: int = TILE_ITEMS,
    wide_basket: int = WIDE_BASKET,
) -> DataFrame:
    """Co-occurring pairs with shared users over all users of either item."""
    pairs, degrees = _pairs_and_degrees(df, min_cooccur, tile_items, wide_basket)
    of_a = degrees.select(F.col("item_id").alias("item_a"), F.col("degree").alias("_da"))
    of_b = degrees.select(F.col("item_id").alias("item_b"), F.col("degree").alias("_db"))
    both = F.col("cooccur_count")
    return (
        pairs.join(of_a, "item_a")
        .join(of_b, "item_b")
        .select(
            "item_a",
            "item_b",
            "cooccur_count",
            half_even(both / (F.col("_da") + F.col("_db") - both), 4).alias("jaccard_similarity"),
        )
    )
