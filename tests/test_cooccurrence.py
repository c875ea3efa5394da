"""Pair counts against brute force, whatever the plan they are made with."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from affinis.operators import cooccurrence
from affinis.operators.cooccurrence import item_cooccurrence, item_jaccard
from tests.helpers import as_set, plan_of

PLANS = [
    {},  # one join key per user
    {"tile_items": 2},  # tiles
    {"tile_items": 2, "wide_basket": 4},  # tiles and wide baskets
    {"tile_items": 1, "wide_basket": 1},  # every basket of two or more is wide
]


def brute(pairs, min_cooccur):
    baskets, holders = defaultdict(set), defaultdict(set)
    for user, item in pairs:
        if user is not None and item is not None:
            baskets[user].add(item)
            holders[item].add(user)
    counts = Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))
    return {
        (a, b, n, len(holders[a] & holders[b]) / len(holders[a] | holders[b]))
        for (a, b), n in counts.items()
        if n >= min_cooccur
    }


def check(spark, pairs, min_cooccur, plan):
    df = spark.createDataFrame(pairs, "user_id BIGINT, item_id BIGINT")
    want = brute(pairs, min_cooccur)
    found = item_jaccard(df, min_cooccur, **plan).collect()
    assert {tuple(r)[:3] for r in found} == {w[:3] for w in want}
    assert len(found) == len(want)
    exact = {w[:2]: w[3] for w in want}
    for row in found:
        assert row["jaccard_similarity"] == pytest.approx(exact[(row["item_a"], row["item_b"])], abs=5.1e-5)
        assert 0 < row["jaccard_similarity"] <= 1


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("min_cooccur", [1, 2, 3])
def test_hot_user_holding_a_third_of_all_rows(spark, plan, min_cooccur):
    pairs = [(1, i) for i in range(30)] + [(2, i) for i in range(20, 40)]
    pairs += [(u, (u * k) % 37) for u in range(3, 12) for k in range(1, 6)]
    pairs += pairs[:7] + [(None, 1), (4, None)]
    check(spark, pairs, min_cooccur, plan)


@pytest.mark.parametrize("plan", PLANS[2:])
def test_more_wide_users_than_bits(spark, plan):
    pairs = [(u, i) for u in range(20) for i in range(u % 5, 9 + u % 3)]
    check(spark, pairs, 2, plan)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    pairs=st.lists(st.tuples(st.integers(1, 6), st.integers(1, 12)), min_size=1, max_size=60),
    plan=st.sampled_from(PLANS),
    min_cooccur=st.integers(1, 3),
)
def test_random_baskets(spark, pairs, plan, min_cooccur):
    check(spark, pairs, min_cooccur, plan)


@pytest.mark.parametrize("plan", PLANS[:2])
def test_tasks_grow_with_the_pairs(spark, monkeypatch, plan):
    monkeypatch.setattr(cooccurrence, "PAIRS_A_TASK", 40)
    pairs = [(u, (u * k) % 97) for u in range(1, 60) for k in range(1, 8)]
    check(spark, pairs, 2, plan)
    df = spark.createDataFrame(pairs, "user_id BIGINT, item_id BIGINT")
    formed = len(set(pairs)) * 3  # about, baskets of seven hold three pairs an item
    dealt = re.findall(r"hashpartitioning\(.*?, (\d+)\), REPARTITION_BY_NUM", plan_of(item_cooccurrence(df, 2, **plan), "simple"))
    assert dealt and min(map(int, dealt)) * 40 >= formed / 2


def test_items_never_together_twice(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 3)], "user_id BIGINT, item_id BIGINT")
    found = item_cooccurrence(df)
    assert found.columns == ["item_a", "item_b", "cooccur_count"]
    assert as_set(found) == set()
    empty = spark.createDataFrame([], "user_id BIGINT, item_id BIGINT")
    assert item_jaccard(empty).count() == 0
