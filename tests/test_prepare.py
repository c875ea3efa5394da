import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from affinis.functions.columns import nan_to_null
from affinis.operators import dedup, encode, prepare
from tests.helpers import as_dict, as_set, plan_of

RAW = "user_id BIGINT, item_id BIGINT, rating DOUBLE, timestamp STRING, seq BIGINT"


def rows(spark, *values):
    return spark.createDataFrame([(*v, i) for i, v in enumerate(values)], RAW)


def test_clip_keeps_null_and_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(None,), (math.nan,), (-1.0,), (7.0,), (3.0,)], "r DOUBLE"))
    clipped = [r["r"] for r in prepare.clip_range(df, "r", 1.0, 5.0).collect()]
    assert clipped == [None, None, 1.0, 5.0, 3.0]
    assert prepare.count_clipped(df, "r", 1.0, 5.0).first()["clipped"] == 2


@pytest.mark.parametrize("hot_rows", [1_000_000, 2, 0])
def test_global_median_is_taken_after_the_user_fill(spark, hot_rows):
    df = rows(
        spark,
        (1, 1, 2.0, "t"), (1, 2, 4.0, "t"), (1, 3, None, "t"), (1, 4, None, "t"),
        (2, 1, 5.0, "t"), (3, 1, None, "t"),
    )
    filled = prepare.impute_group_median(df, hot_rows=hot_rows)
    # user 1 fills with 3.0 twice; the median of 2, 3, 3, 4, 5 is 3, of 2, 4, 5 it would be 4
    assert as_dict(filled, "seq", "rating") == {0: 2.0, 1: 4.0, 2: 3.0, 3: 3.0, 4: 5.0, 5: 3.0}


def test_unreadable_time_wins_its_pair_and_is_dropped(spark):
    df = rows(
        spark,
        (1, 1, 3.0, "2024-01-01 00:00:00"), (1, 1, 4.0, None),
        (2, 2, 3.0, "2024-01-01 00:00:00"), (2, 2, 4.0, "garbage"),
        (3, 3, 3.0, "2024-01-01 00:00:00"), (3, 3, 4.0, "2024-01-02 00:00:00"),
    )
    assert as_set(prepare.clean_interactions(df, ["seq"]), "user_id", "rating") == {(3, 4.0)}
    sane = prepare.clean_interactions(df, ["seq"], parse_first=True)
    assert as_set(sane, "user_id", "rating") == {(1, 3.0), (2, 3.0), (3, 4.0)}


def test_clean_interactions_on_injected_dirt(spark):
    ratings = [6.0, -1.0, None, 5.5, 0.5, None]
    df = rows(spark, *[(1, i, r, "2024-01-01 00:00:00") for i, r in enumerate(ratings)], (None, 9, 3.0, "x"))
    found = as_dict(prepare.clean_interactions(df), "item_id", "rating")
    # the median of 6, -1, 5.5, 0.5 is 3
    assert found == {0: 5.0, 1: 1.0, 2: 3.0, 3: 5.0, 4: 1.0, 5: 3.0}


def test_hot_pair_is_cut_before_the_shuffle(spark):
    df = rows(spark, *[(1, 1, 3.0, "2024-01-01 00:00:00")] * 20)
    latest = dedup.dedup_keep_latest(df, tiebreak=["seq"])
    assert [r["seq"] for r in latest.collect()] == [19]
    assert "WindowGroupLimit" in plan_of(latest)


def test_keep_first_is_by_the_given_order(spark):
    df = rows(spark, (1, 1, 3.0, "b"), (1, 1, 4.0, "a"), (None, 1, 1.0, "c"), (None, 1, 2.0, "d"))
    kept = dedup.dedup_keep_first(df, ["user_id", "item_id"], ["timestamp"])
    assert as_set(kept, "user_id", "rating") == {(1, 4.0), (None, 1.0)}


def test_types_round_half_even_and_bad_ids(spark):
    df = spark.createDataFrame([("1", "2", 2.25), ("x", "2", 2.35)], "user_id STRING, item_id STRING, rating DOUBLE")
    assert as_set(prepare.normalize_types(df, lenient=True)) == {(1, 2, 2.2), (None, 2, 2.4)}
    with pytest.raises(PySparkException):
        prepare.normalize_types(df).collect()


def test_parse_keeps_bad_rows_when_asked(spark):
    df = spark.createDataFrame([("2024-02-30 00:00:00",), ("2024-02-29 00:00:00",), (None,)], "timestamp STRING")
    assert prepare.parse_timestamps(df).count() == 1
    assert prepare.parse_timestamps(df, drop_bad=False).count() == 3
    assert prepare.count_bad_timestamps(df).first()[0] == 2


PRODUCTS = "item_id BIGINT, category STRING, brand STRING, price DOUBLE, rating DOUBLE, in_stock BOOLEAN"


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_clean_products(spark, hot_rows):
    df = spark.createDataFrame(
        [
            (1, "home", "A", -50.0, 6.0, None), (2, None, "B", 10.0, 4.0, False),
            (3, "home", None, 30.0, None, True), (4, "home", "C", None, 1.0, True),
            (2, "zzz", "Z", 99.0, 1.0, True),
        ],
        PRODUCTS,
    )
    found = prepare.clean_products(df, ["price"], hot_rows)
    assert as_set(found, "item_id", "category", "price", "rating", "in_stock") == {
        (1, "home", 20.0, 5.0, True), (2, "unknown", 10.0, 4.0, False),
        (3, "home", 30.0, None, True), (4, "home", None, 1.0, True),
    }


def test_clean_products_without_optional_columns(spark):
    df = spark.createDataFrame([(1, None, 5.0)], "item_id BIGINT, category STRING, price DOUBLE")
    assert as_set(prepare.clean_products(df)) == {(1, "unknown", 5.0)}


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_labels_follow_text_order_and_null_is_a_class(spark, hot_rows):
    df = spark.createDataFrame(
        [(1, "b", "Z", 1.0), (2, "a", None, 3.0), (3, "b", "a", 2.0)],
        "item_id BIGINT, category STRING, brand STRING, price DOUBLE",
    )
    coded, encoders = encode.encode_products(df, hot_rows)
    assert as_set(coded, "item_id", "category_encoded", "brand_encoded", "price_normalized") == {
        (1, 1, 0, 0.0), (2, 0, 2, 1.0), (3, 1, 1, 0.5),
    }
    assert as_dict(encoders["brand"], "value", "code") == {"Z": 0, "a": 1, "nan": 2}
    new = spark.createDataFrame([(9, "zz", "a", 5.0)], df.schema)
    again = encode.transform_products(new, encoders)
    assert as_set(again, "category_encoded", "brand_encoded", "price_normalized") == {(None, 1, 2.0)}


def test_absent_brand_is_skipped_and_constant_price_is_zero(spark):
    df = spark.createDataFrame([(1, "a", 4.0), (2, "a", 4.0), (3, "a", None)], "item_id BIGINT, category STRING, price DOUBLE")
    coded, encoders = encode.encode_products(df)
    assert "brand_encoded" not in coded.columns and "brand" not in encoders
    assert as_set(coded, "item_id", "price_normalized") == {(1, 0.0), (2, 0.0), (3, None)}


def test_fill_defaults_skips_absent_columns(spark):
    df = spark.createDataFrame([(None, 1)], "category STRING, x BIGINT")
    assert as_set(prepare.fill_defaults(df)) == {("unknown", 1)}
    assert as_set(prepare.fill_defaults(df.withColumn("x", F.lit(None).cast("long")), {"x": 7}), "x") == {(7,)}
