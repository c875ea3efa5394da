"""The order-free mean against exact fractions."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from affinis.functions.columns import stable_mean
from affinis.operators.features import user_rating_gap


def mean_of(spark, values, parts=1):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x DOUBLE").repartition(parts)
    return df.agg(stable_mean(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "values,mean", [([1e-7, 3e-7], 2e-7), ([2e13, 4e13], 3e13), ([0.1, 0.2, None], 0.15), ([1e300, 1e300], 1e300),
                    ([5e-320], 5e-320), ([-1e15, 1e15, 3.0], 1.0), ([None], None), ([], None), ([-0.1, -0.2], -0.15)],
)
def test_values_of_any_size(spark, values, mean):
    assert mean_of(spark, values) == (mean if mean is None else pytest.approx(mean, rel=1e-15))


def test_same_for_every_partitioning_and_next_to_the_exact_mean(spark):
    draw = random.Random(5)
    values = [draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.randint(-7, 15) for _ in range(3000)]
    exact = sum(map(Fraction, values)) / len(values)
    found = {mean_of(spark, draw.sample(values, len(values)), parts) for parts in (1, 3, 8, 8)}
    assert len(found) == 1 and abs(Fraction(found.pop()) - exact) <= abs(exact) * Fraction(1, 2**50)


def test_decimals_average_as_decimals_and_weights_count(spark):
    df = spark.createDataFrame([(3.4, 5), (3.5, 5), (None, 9)], "x DOUBLE, n BIGINT")
    assert df.agg(stable_mean(F.col("x"), F.col("n"))).first()[0] == 3.45
    df = spark.createDataFrame([(1 / 3, 2), (2 / 3, 1)], "x DOUBLE, n BIGINT")
    assert df.agg(stable_mean(F.col("x"), F.col("n"))).first()[0] == pytest.approx(4 / 9, rel=1e-15)


def test_gaps_of_large_and_small_ratings(spark):
    df = spark.createDataFrame(
        [(1, 1, 2e13), (1, 2, 4e13), (2, 1, 1e-7), (2, 2, 3e-7)], "user_id BIGINT, item_id BIGINT, rating DOUBLE"
    )
    gaps = {(r.user_id, r.item_id): r.user_item_gap for r in user_rating_gap(df).collect()}
    assert gaps == {(1, 1): -1e13, (1, 2): 1e13, (2, 1): 0.0, (2, 2): 0.0}  # rounded to four places
