import re
import statistics

import pytest

from affinis.operators import eda, features
from affinis.schemas import FEATURE_TABLES
from tests.helpers import as_dict, as_set, plan_of

IX = "user_id BIGINT, item_id BIGINT, rating DOUBLE, timestamp STRING, event_type STRING"
AS_OF = "2024-01-11 00:00:00"


@pytest.fixture(scope="module")
def ix(spark):
    return spark.createDataFrame(
        [
            (1, 10, 1.0, "2024-01-06 23:30:00", "purchase"),
            (1, 10, 2.0, "2024-01-07 01:00:00", "view"),
            (1, 11, 4.5, "2024-01-08 12:00:00", "error"),
            (2, 10, None, "junk", None),
            (None, 10, 5.0, "2024-01-01 00:00:00", "view"),
        ],
        IX,
    )


def test_user_features(spark, ix):
    found = {r["user_id"]: r for r in features.user_features(ix, AS_OF).collect()}
    assert set(found) == {1, 2}  # no group for the missing user
    one = found[1]
    assert (one["total_interactions"], one["unique_items"]) == (3, 2)
    assert one["avg_rating_given"] == 2.5
    assert one["std_rating_given"] == round(statistics.stdev([1, 2, 4.5]), 4)
    assert (one["purchase_count"], one["view_count"], one["wishlist_count"], one["cart_count"]) == (1, 1, 0, 0)
    assert one["activity_score"] == 5
    assert one["recency_days"] == 2.5
    assert one["created_at"] == AS_OF
    two = found[2]
    assert (two["avg_rating_given"], two["std_rating_given"], two["recency_days"]) == (None, 0.0, 999.0)


def test_columns_match_the_declared_tables(spark, ix):
    catalog = spark.createDataFrame(
        [(10, "c", 2.0, 0.1, "b", 3)],
        "item_id BIGINT, category STRING, price DOUBLE, price_normalized DOUBLE, brand STRING, category_encoded BIGINT",
    )
    for name, df in {
        "user_features": features.user_features(ix, AS_OF),
        "item_features": features.item_features(ix, catalog, AS_OF),
        "interaction_features": features.interaction_features(ix),
    }.items():
        declared = FEATURE_TABLES[name][0]
        assert df.columns == declared.names
        assert [f.dataType for f in df.schema] == [f.dataType for f in declared]


def test_without_event_types_and_custom_weights(spark, ix):
    bare = features.user_features(ix.drop("event_type"), AS_OF)
    assert as_dict(bare, "user_id", "activity_score") == {1: 0, 2: 0}
    weighted = features.user_features(ix, AS_OF, {"purchase": 10, "view": 3})
    assert as_dict(weighted, "user_id", "activity_score") == {1: 13, 2: 0}
    assert "event_type" not in features.interaction_features(ix.drop("event_type")).columns


def test_item_features_keep_items_outside_the_catalog(spark, ix):
    catalog = spark.createDataFrame([(10, "c", 2.0)], "item_id BIGINT, category STRING, price DOUBLE")
    found = {r["item_id"]: r for r in features.item_features(ix, catalog, AS_OF).collect()}
    assert (found[10]["total_interactions"], found[10]["unique_users"], found[10]["category"]) == (3, 2, "c")
    assert (found[10]["popularity_score"], found[11]["popularity_score"]) == (1.0, 0.0)
    assert found[11]["category"] is None and found[11]["std_rating_received"] == 0.0
    assert "brand" not in found[10].asDict()


def test_single_item_has_popularity_zero(spark):
    one = spark.createDataFrame([(1, 1, 2.0)], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    scored = features.popularity_score(features.item_activity_agg(one))
    assert scored.first()["popularity_score"] == 0.0


def test_interaction_features(spark, ix):
    found = {(r["user_id"], r["item_id"]): r for r in features.interaction_features(ix, ["timestamp"]).collect()}
    row = found[(1, 10)]  # Saturday 2024-01-06 comes first
    assert (row["hour_of_day"], row["day_of_week"], row["is_weekend"]) == (23, 5, 1)
    assert (row["user_item_gap"], row["timestamp"]) == (-1.5, "2024-01-06 23:30:00")
    bad = found[(2, 10)]
    assert (bad["hour_of_day"], bad["day_of_week"], bad["is_weekend"]) == (None, None, 0)
    assert bad["user_item_gap"] is None and bad["timestamp"] is None


def test_event_join(spark, ix):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id BIGINT")
    assert as_set(features.join_event_counts(users, ix, "view")) == {(1, 1), (2, 0), (3, 0)}


def test_rating_bins_close_on_the_right(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.5, 2.0, 3.0, 3.1)], "rating DOUBLE")
    assert as_set(eda.rating_histogram(df, [1.0, 2.0, 3.0]), "bin", "count") == {(0, 2), (1, 2)}


def test_activity_bins_and_equal_counts(spark):
    df = spark.createDataFrame([(u, i) for u in range(4) for i in range(3)], "user_id BIGINT, item_id BIGINT")
    assert as_set(eda.activity_histogram(df, 10), "bin", "users") == {(5, 4)}
    uneven = spark.createDataFrame([(u, i) for u in range(5) for i in range(u + 1)], "user_id BIGINT, item_id BIGINT")
    assert as_set(eda.activity_histogram(uneven, 2), "bin", "low", "users") == {(0, 1.0, 2), (1, 3.0, 3)}


def test_activity_stats_and_ranks(spark):
    df = spark.createDataFrame([(u, i) for u in range(1, 5) for i in range(u)], "user_id BIGINT, item_id BIGINT")
    assert eda.user_activity_stats(df).first().asDict() == {"min": 1, "max": 4, "mean": 2.5, "median": 2.5}
    ranks = [(0, 4, 1), (1, 3, 2), (2, 2, 3), (3, 1, 4)]
    for hot_rows in (100, 1):
        found = eda.popularity_rank(df, hot_rows)
        assert as_set(found, "item_id", "interactions", "rank") == set(ranks)
    assert [r["item_id"] for r in eda.top_items(df, 2).collect()] == [0, 1]


def test_pivot_matches_cells(spark):
    df = spark.createDataFrame(
        [(1, 5, 2.0), (1, 5, 4.0), (2, 6, 1.0)], "user_id BIGINT, item_id BIGINT, rating DOUBLE"
    )
    assert as_set(eda.submatrix_pivot(df, [5, 6])) == {(1, 3.0, 0.0), (2, 0.0, 1.0)}
    assert as_set(eda.active_submatrix(df, 5, 1)) == {(1, 5, 3.0)}
    assert eda.submatrix_sparsity(df, 5, 2).first()["sparsity"] == 0.5


def test_optional_columns_of_the_summary(spark, ix):
    bare = ix.select("user_id", "item_id", "rating", "timestamp")
    catalog = spark.createDataFrame([(1,)], "item_id BIGINT")
    sections = {r["section"] for r in eda.eda_summary(bare, catalog).collect()}
    assert "event_types" not in sections and "product_categories" not in sections
    assert {"totals", "top_10_items", "user_activity", "rating_distribution"} <= sections


@pytest.mark.parametrize("hot_rows", [1_000, 2])
def test_box_stats(spark, hot_rows):
    prices = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", p) for p in prices] + [(None, 1.0)], "category STRING, price DOUBLE")
    found = eda.price_box_stats(df, hot_rows).collect()
    assert [tuple(r) for r in found] == [("a", 2.0, 3.0, 4.0, 1.0, 4.0, 1)]


def test_only_the_pair_is_held_for_distinct_users(spark):
    rows = [(1, 7, 4.0), (1, 7, 2.0), (2, 7, 3.0), (None, 7, 1.0), (None, 8, 5.0), (3, None, 1.0)]
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    found = features.item_activity_agg(df)
    assert as_set(found, "item_id", "total_interactions", "unique_users", "avg_rating_received") == {(7, 3, 2, 2.5), (8, 0, 0, 5.0)}
    by_pair = re.findall(r"keys=\[item_id#\d+L, user_id#\d+L\], functions=\[(.*?)\]", plan_of(found, "simple"))
    assert by_pair and not any(by_pair)


def test_item_activity_computes_the_interactions_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(u, u % 4, float(u % 5)) for u in range(40)] + [(None, 1, 2.0), (7, None, 1.0), (8, 0, None), (8, 0, 3.0)]
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    found = features.item_activity_agg(df.mapInArrow(counted, df.schema))
    want = {(0, 12, 10), (1, 10, 10), (2, 10, 10), (3, 10, 10)}
    assert as_set(found, "item_id", "total_interactions", "unique_users") == want
    assert seen.value == len(rows)
