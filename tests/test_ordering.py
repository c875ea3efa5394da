"""Every helper must give the same answer whether or not its groups count as hot."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from affinis.functions.ordering import quantiles, split_hot, with_group_position, with_position
from tests.helpers import as_dict, as_set


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows belong to group 1; values repeat."""
    rng = np.random.default_rng(5)
    groups = np.where(np.arange(900) % 3 == 0, 1, rng.integers(2, 40, 900))
    return pd.DataFrame(
        {"g": groups, "v": np.round(rng.normal(0, 3, 900), 1), "id": rng.permutation(900)}
    )


def test_position_over_the_table(spark, skewed):
    df = spark.createDataFrame(skewed)
    order = [F.desc("v"), F.col("id")]
    plain = as_set(with_position(df, order, "p"), "id", "p")
    sliced = as_set(with_position(df, order, "p", hot_rows=10), "id", "p")
    assert plain == sliced
    assert sorted(p for _, p in plain) == list(range(900))


def test_position_in_group_with_hot_group(spark, skewed):
    df = spark.createDataFrame(skewed)
    expected = skewed.sort_values(["g", "v", "id"])
    expected["p"] = expected.groupby("g").cumcount()
    expected["n"] = expected.groupby("g")["id"].transform("size")
    want = set(map(tuple, expected[["g", "id", "p", "n"]].to_numpy().tolist()))
    for hot_rows in (10_000, 100, 5, 0):
        placed = with_group_position(df, ["g"], ["v", "id"], "p", "n", hot_rows)
        got = {tuple(map(float, r)) for r in placed.select("g", "id", "p", "n").collect()}
        assert got == want, hot_rows


def test_split_hot_keeps_every_row(spark, skewed):
    df = spark.createDataFrame(skewed)
    rest, hot = split_hot(df, ["g"], 100)
    assert {r["g"] for r in hot.select("g").distinct().collect()} == {1}
    assert rest.count() + hot.count() == 900
    assert split_hot(df, ["g"], 899)[1] is None  # larger table, no hot group
    assert split_hot(df, ["g"], 900)[1] is None


@pytest.mark.parametrize("hot_rows", [10_000, 20, 3, 0])
def test_group_quantiles_match_numpy(spark, skewed, hot_rows):
    df = spark.createDataFrame(skewed)
    found = quantiles(df, ["g"], "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9}, hot_rows).collect()
    assert len(found) == skewed["g"].nunique()
    for row in found:
        values = skewed.loc[skewed["g"] == row["g"], "v"]
        want = np.quantile(values, [0.25, 0.5, 0.9])
        assert np.allclose([row["q1"], row["q2"], row["q9"]], want)


@pytest.mark.parametrize("hot_rows", [10_000, 20, 0])
def test_overall_median_ignores_nulls(spark, skewed, hot_rows):
    df = spark.createDataFrame(skewed).withColumn("v", F.when(F.col("id") % 7 > 0, F.col("v")))
    want = skewed.loc[skewed["id"] % 7 > 0, "v"].median()
    assert quantiles(df, [], "v", {"m": 0.5}, hot_rows).first()["m"] == pytest.approx(want)


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([], "g BIGINT, v DOUBLE")
    assert quantiles(empty, ["g"], "v", {"m": 0.5}).count() == 0
    assert as_dict(quantiles(empty, [], "v", {"m": 0.5}), "m", "m") == {None: None}
