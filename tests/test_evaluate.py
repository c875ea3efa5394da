import math
from collections import Counter

import pytest

from affinis.operators import evaluate, joins, split
from affinis.plans import queries
from tests.helpers import as_dict, as_set


def recs(spark, lists):
    return spark.createDataFrame(
        [(u, i, r) for u, items in lists.items() for r, i in enumerate(items, start=1)],
        "user_id BIGINT, item_id BIGINT, rank BIGINT",
    )


def pairs(spark, sets):
    return spark.createDataFrame([(u, i) for u, items in sets.items() for i in items], "user_id BIGINT, item_id BIGINT")


def test_metrics_by_hand(spark):
    lists = {1: [10, 11, 12, 13], 2: [10], 3: [5]}
    truth = {1: [11, 13, 99], 2: [10, 20], 4: [1]}  # 3 has no truth, 4 no list
    scores = {r["user_id"]: r for r in evaluate.score_users(recs(spark, lists), pairs(spark, truth), 3).collect()}
    assert set(scores) == {1, 2, 4}
    ideal3 = 1 + 1 / math.log2(3) + 1 / 2
    assert scores[1]["precision"] == pytest.approx(1 / 3)
    assert scores[1]["recall"] == pytest.approx(1 / 3)
    assert scores[1]["ndcg"] == pytest.approx((1 / math.log2(3)) / ideal3)
    assert scores[2]["precision"] == pytest.approx(1 / 3)
    assert scores[2]["recall"] == pytest.approx(1 / 2)
    assert scores[2]["ndcg"] == pytest.approx(1 / (1 + 1 / math.log2(3)))
    assert (scores[4]["precision"], scores[4]["recall"], scores[4]["ndcg"]) == (0, 0, 0)


def test_means_over_asked_users_only(spark):
    lists, truth = {1: [10], 2: [10]}, {1: [10], 2: [11], 4: [1]}
    users = spark.createDataFrame([(1,), (2,), (7,)], "user_id BIGINT")
    found = evaluate.evaluate_recommendations(recs(spark, lists), pairs(spark, truth), users, 1).first()
    assert found.asDict() == {"precision_at_1": 0.5, "recall_at_1": 0.5, "ndcg_at_1": 0.5, "evaluated_users": 2}


def test_no_users_and_k_zero(spark):
    nobody = pairs(spark, {})
    found = evaluate.evaluate_recommendations(recs(spark, {1: [1]}), nobody).first()
    assert found.asDict() == {"precision_at_10": 0.0, "recall_at_10": 0.0, "ndcg_at_10": 0.0, "evaluated_users": 0}
    zero = evaluate.precision_at_k(recs(spark, {1: [1]}), pairs(spark, {1: [1]}), 0)
    assert as_dict(zero, "user_id", "precision") == {1: 0.0}


def test_ground_truth_is_distinct_and_bounded(spark):
    test = spark.createDataFrame(
        [(1, 1, 3.0), (1, 1, 4.0), (1, 2, 2.9), (2, 3, None)], "user_id BIGINT, item_id BIGINT, rating DOUBLE"
    )
    assert as_set(evaluate.relevance_ground_truth(test)) == {(1, 1)}


@pytest.mark.parametrize("hot_rows", [1_000, 4])
def test_split_sizes(spark, hot_rows):
    rows = [(u, i, f"2024-01-{i + 1:02d}") for u in range(1, 13) for i in range(u)]
    df = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, timestamp STRING")
    parts = split.temporal_holdout_split(df, ["timestamp"], hot_rows=hot_rows)
    held = {r["user_id"]: r["count"] for r in parts.filter("is_test").groupBy("user_id").count().collect()}
    assert held == {u: u - int(u * 0.8) for u in range(1, 13)}  # one row alone is test
    assert parts.count() == len(rows)
    last = parts.filter("is_test AND user_id = 10")
    assert as_set(last, "item_id") == {(8,), (9,)}


def test_membership_joins(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(20)], "user_id BIGINT, item_id BIGINT")
    assert joins.semi_join_entities(df, "user_id", [1, 5, 99]).count() == 2
    many = list(range(10, 3_000))
    assert joins.semi_join_entities(df, "user_id", many).count() == 10
    ids = spark.createDataFrame([(3,), (3,)], "x BIGINT")
    assert joins.semi_join_entities(df, "user_id", ids).count() == 1
    rated = spark.createDataFrame([(1, 10, 2.0), (2, 20, 0.0)], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    left = joins.anti_join_seen(df.filter("user_id IN (1, 2)"), rated)
    assert as_set(left) == {(2, 20)}


def test_offers_grow_with_own_ratings(spark):
    """One user with many items does not lengthen the lists of the others."""
    rows = [(1, i, 4.0) for i in range(400)] + [(u, i, 4.0) for u in range(2, 40) for i in range(u % 4)] + [(2, 7, 0.0)]
    train = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    users = spark.createDataFrame([(u,) for u in range(1, 45)], "user_id long")
    own = {u: {i for v, i, _ in rows if v == u} for u in range(1, 45)}
    times = Counter(i for _, i, _ in rows)
    order = sorted(times, key=lambda i: (-times[i], i))
    for head in (7, 1000):
        found = [tuple(r) for r in queries._offered(train, users, head).select("user_id", "place", "item_id").collect()]
        assert sorted(found) == [(u, k + 1, i) for u in sorted(own) for k, i in enumerate(order[: len(own[u]) + 10])]
    seen = {(u, i) for u, i, r in rows if r > 0}
    best = {u: [i for i in order if (u, i) not in seen][:10] for u in own}
    ranked = {(r.user_id, r.rank, r.item_id) for r in queries._popular_unseen(train, users).collect()}
    assert ranked == {(u, k + 1, i) for u in own for k, i in enumerate(best[u])}
