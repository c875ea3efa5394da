"""Every registered query against its SQL, and the plans that must not appear."""

import pytest

import __spark_entry__ as entry_module
from affinis.plans.queries import QUERIES
from tests.helpers import plan_of
from tools.check_oracles import check, connect

PLANNED = [
    "clean_interactions", "clean_products", "encode_products", "user_features", "item_features",
    "interaction_features", "item_cooccurrence", "item_jaccard", "user_rating_gap", "temporal_holdout_split",
    "run_suite", "evaluate_recommendations", "eda_summary", "price_box_stats", "active_submatrix",
    "day_hour_density", "item_similarity_top_n", "recommend_top_k", "fs_online_lookup",
]
ROWS_ONLY = {"table_checksum_hash64"}


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def no_cross_join_and_no_row_udf(frame):
    plan = plan_of(frame)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, sf, name):
    inspect = no_cross_join_and_no_row_udf if name in PLANNED else None
    assert check(spark, duck, sf, name, inspect) == []


def test_entry_points(spark):
    assert set(QUERIES) - set(entry_module.oracle_sql()) == ROWS_ONLY
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    flagship = entry_module.entry(spark)
    assert flagship.columns[0] == "user_id" and not flagship.isEmpty()


def test_scans_read_only_the_columns_asked_for(spark, sf):
    plan = plan_of(QUERIES["user_activity_stats"](spark, sf))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
