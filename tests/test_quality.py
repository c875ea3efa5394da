import json

import pytest

from affinis.operators import quality
from tests.helpers import as_dict

IX = "user_id BIGINT, item_id BIGINT, rating DOUBLE, timestamp STRING, event_type STRING"


@pytest.fixture(scope="module")
def results(spark):
    good = [(u, u, 3.0, f"2024-01-01 00:{u % 60:02d}:00", "view") for u in range(1, 120)]
    bad = [(0, 1, 9.0, "2024-02-30 00:00:00", "click"), (5, 5, None, "2024-1-1", None), (1, 1, 3.0, "2024-01-01 00:01:00", "cart")]
    df = spark.createDataFrame(good + bad, IX)
    found = quality.run_suite(df, "interactions", quality.INTERACTIONS_SUITE).collect()
    return {(r["expectation"], r["column"]): r for r in found}


def test_every_rule_gives_a_row(results):
    assert len(results) == len(quality.INTERACTIONS_SUITE)


@pytest.mark.parametrize(
    "rule, column, unexpected, status",
    [
        ("row_count_between", "", 0, "PASS"),
        ("not_null", "rating", 1, "FAIL"),
        ("not_null", "user_id", 0, "PASS"),
        ("between", "rating", 1, "FAIL"),
        ("column_min_between", "user_id", 1, "FAIL"),
        ("column_min_between", "item_id", 0, "PASS"),
        ("compound_unique", "user_id,item_id,timestamp", 2, "FAIL"),
        ("strftime_format", "timestamp", 2, "FAIL"),
        ("in_set", "event_type", 1, "FAIL"),
    ],
)
def test_rule(results, rule, column, unexpected, status):
    row = results[(rule, column)]
    assert (row["unexpected_count"], row["status"]) == (unexpected, status)


def test_nulls_are_not_counted_in_shares(results):
    assert results[("in_set", "event_type")]["element_count"] == 121
    assert results[("in_set", "event_type")]["unexpected_pct"] == round(100 / 121, 4)
    assert results[("not_null", "rating")]["element_count"] == 122


def test_absent_columns(spark):
    df = spark.createDataFrame([(1, "t", 1.0)], "item_id BIGINT, title STRING, price DOUBLE")
    found = quality.run_suite(df, "products", quality.PRODUCTS_SUITE)
    status = {(r["expectation"], r["column"]): r["status"] for r in found.collect()}
    assert status[("between", "rating")] == "SKIPPED"
    assert status[("not_null", "category")] == "FAIL"
    assert status[("columns_superset", "item_id,title,category,price")] == "FAIL"
    assert status[("row_count_between", "")] == "FAIL"
    summary = quality.suite_summary(found).first()
    assert (summary["evaluated"], summary["passed"], summary["success"]) == (9, 5, False)
    assert summary["pass_pct"] == 55.6


def test_empty_table(spark):
    df = spark.createDataFrame([], IX)
    status = as_dict(quality.run_suite(df, "d", quality.INTERACTIONS_SUITE), "position", "status")
    assert status[1] == "FAIL" and status[3] == "PASS" and status[10] == "PASS"


def test_suite_from_a_file(spark, tmp_path):
    path = tmp_path / "suite.json"
    path.write_text(json.dumps([{"rule": "in_set", "column": "x", "values": [1, 2]}]))
    df = spark.createDataFrame([(1,), (3,)], "x BIGINT")
    found = quality.run_suite(df, "d", quality.load_suite(str(path))).first()
    assert (found["unexpected_count"], json.loads(found["kwargs"])) == (1, {"column": "x", "values": [1, 2]})


STORED = {
    "data_asset_type": None,
    "expectation_suite_name": "events",
    "expectations": [
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 3}, "meta": {}},
        {"expectation_type": "expect_table_columns_to_match_set", "kwargs": {"column_set": ["x", "y"], "exact_match": False}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "x", "max_value": 2, "min_value": 1}},
        {"expectation_type": "expect_compound_columns_to_be_unique", "kwargs": {"column_list": ["x", "y"]}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "z", "value_set": ["a"]}},
    ],
}


def test_stored_suite(spark, tmp_path):
    path = tmp_path / "suite.json"
    path.write_text(json.dumps(STORED, indent=2))
    df = spark.createDataFrame([(1, "a"), (3, "b"), (3, "b")], "x BIGINT, y STRING")
    status = as_dict(quality.run_suite(df, "d", quality.load_suite(str(path), optional=["z"])), "position", "status")
    assert status == {1: "PASS", 2: "PASS", 3: "FAIL", 4: "FAIL", 5: "SKIPPED"}
    assert as_dict(quality.run_suite(df, "d", quality.load_suite(str(path))), "position", "status")[5] == "FAIL"


@pytest.mark.parametrize("suite", [quality.INTERACTIONS_SUITE, quality.PRODUCTS_SUITE])
def test_suites_survive_storing(spark, tmp_path, suite):
    (tmp_path / "s.json").write_text(quality.stored_suite("s", suite))
    optional = [r["column"] for r in suite if r.get("optional")]
    loaded = quality.load_suite(str(tmp_path / "s.json"), optional)
    assert [r for r in loaded if r["rule"] != "between"] == [r for r in suite if r["rule"] != "between"] and len(loaded) == len(suite)


@pytest.mark.parametrize(
    "change", [{"expectation_type": "expect_magic"}, {"kwargs": {"column": "x", "mostly": 0.9}}, {"kwargs": {"column": "x", "odd": 1}}]
)
def test_what_a_stored_suite_cannot_say(spark, tmp_path, change):
    stored = {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "x"}, **change}
    (tmp_path / "s.json").write_text(json.dumps({"expectations": [stored]}))
    with pytest.raises(ValueError):
        quality.load_suite(str(tmp_path / "s.json"))


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        quality.expectation(spark.range(1), "d", {"rule": "nope", "column": "id"})
