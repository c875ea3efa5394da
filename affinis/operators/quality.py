"""Data-quality rules as data, compiled to one aggregate per table.

A suite is a list of dicts {"rule": ..., "column"/"columns": ..., parameters}. All row-level rules
of a suite share one pass; each uniqueness rule adds one grouping.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.functions.columns import half_even

# --- fixed values: the two suites ---------------------------------------------
INTERACTIONS_SUITE = [
    {"rule": "row_count_between", "min": 100},
    {"rule": "columns_superset", "columns": ["user_id", "item_id", "rating", "timestamp"]},
    {"rule": "not_null", "column": "user_id"},
    {"rule": "not_null", "column": "item_id"},
    {"rule": "not_null", "column": "rating"},
    {"rule": "not_null", "column": "timestamp"},
    {"rule": "between", "column": "rating", "min": 1.0, "max": 5.0},
    {"rule": "column_min_between", "column": "user_id", "min": 1},
    {"rule": "column_min_between", "column": "item_id", "min": 1},
    {"rule": "compound_unique", "columns": ["user_id", "item_id", "timestamp"]},
    {"rule": "strftime_format", "column": "timestamp", "format": "%Y-%m-%d %H:%M:%S"},
    {"rule": "in_set", "column": "event_type", "values": ["view", "purchase", "wishlist", "cart"],
     "optional": True},
]
PRODUCTS_SUITE = [
    {"rule": "row_count_between", "min": 10},
    {"rule": "columns_superset", "columns": ["item_id", "title", "category", "price"]},
    {"rule": "not_null", "column": "item_id"},
    {"rule": "not_null", "column": "title"},
    {"rule": "not_null", "column": "category"},
    {"rule": "not_null", "column": "price"},
    {"rule": "unique", "column": "item_id"},
    {"rule": "between", "column": "price", "min": 0.01},
    {"rule": "in_set", "column": "category",
     "values": ["electronics", "clothing", "home", "books", "sports", "beauty"]},
    {"rule": "between", "column": "rating", "min": 0.0, "max": 5.0, "optional": True},
]
# strftime codes and their Spark pattern letters
TIME_CODES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}
# Names of rules and parameters in stored suites.
STORED_RULES = {
    "expect_table_row_count_to_be_between": "row_count_between",
    "expect_table_columns_to_match_set": "columns_superset",
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_between": "between",
    "expect_column_min_to_be_between": "column_min_between",
    "expect_column_values_to_be_unique": "unique",
    "expect_compound_columns_to_be_unique": "compound_unique",
    "expect_column_values_to_match_strftime_format": "strftime_format",
    "expect_column_values_to_be_in_set": "in_set",
}
STORED_PARAMETERS = {
    "min_value": "min", "max_value": "max", "column_set": "columns", "column_list": "columns",
    "strftime_format": "format", "value_set": "values",
}
# --- end of fixed values --------------------------------------------------------

RESULT_COLUMNS = [
    "dataset", "position", "expectation", "column", "kwargs", "observed", "element_count",
    "unexpected_count", "unexpected_pct", "status",
]


def load_suite(path: str, optional: Sequence[str] = ()) -> list[dict]:
    """A suite from a JSON file, read through Spark: a list of rule dicts as above, or a stored suite.

    A stored suite is an object whose `expectations` each have an `expectation_type` and its `kwargs`. It does not say which
    columns may be absent: `optional` does.
    """
    rows = SparkSession.active().read.text(path, wholetext=True).collect()  # one small file
    if len(rows) != 1:
        raise ValueError(f"{path} holds {len(rows)} files, not one suite")
    stored = json.loads(rows[0]["value"])
    rules = stored if isinstance(stored, list) else [_from_stored(e) for e in stored["expectations"]]
    return [{**r, "optional": True} if r.get("column") in optional else r for r in rules]


def _from_stored(expectation: dict) -> dict:
    kind, kwargs = expectation["expectation_type"], dict(expectation.get("kwargs", {}))
    if kind not in STORED_RULES:
        raise ValueError(f"unknown expectation {kind}")
    if kwargs.pop("exact_match", False):
        raise ValueError("a set of columns can only be asked for as a part of all columns")
    if kwargs.pop("mostly", 1.0) != 1.0:
        raise ValueError("rules hold for all rows: `mostly` is not supported")
    # Parameters in one order, as the result lists them.
    named = {STORED_PARAMETERS.get(k, k): v for k, v in kwargs.items() if v is not None}
    order = ["column", "columns", "min", "max", "format", "values"]
    unknown = sorted(set(named) - set(order))
    if unknown:
        raise ValueError(f"unknown parameters of {kind}: {unknown}")
    return {"rule": STORED_RULES[kind], **{k: named[k] for k in order if k in named}}


def stored_suite(name: str, suite: list[dict]) -> str:
    """The stored form of a suite, as JSON text."""
    kinds = {rule: kind for kind, rule in STORED_RULES.items()}
    parameters = {"min": "min_value", "max": "max_value", "format": "strftime_format", "values": "value_set"}

    def stored(rule: dict) -> dict:
        columns = "column_set" if rule["rule"] == "columns_superset" else "column_list"
        kwargs = {columns if k == "columns" else parameters.get(k, k): v for k, v in rule.items() if k not in ("rule", "optional")}
        if columns in kwargs and columns == "column_set":
            kwargs["exact_match"] = False
        return {"expectation_type": kinds[rule["rule"]], "kwargs": kwargs, "meta": {}}

    return json.dumps({"expectation_suite_name": name, "expectations": [stored(r) for r in suite], "meta": {}})


def spark_time_pattern(code: str) -> str:
    for short, letters in TIME_CODES.items():
        code = code.replace(short, letters)
    return code


def _columns(rule: dict) -> list[str]:
    return rule["columns"] if "columns" in rule else [rule["column"]] if "column" in rule else []


def _kwargs(rule: dict) -> str:
    return json.dumps({k: v for k, v in rule.items() if k not in ("rule", "optional")})


def _outside(value: Column, rule: dict) -> Column:
    """Null-safe test of a bound: null when `value` is null."""
    outside = F.lit(False) & value.isNotNull()
    if rule.get("min") is not None:
        outside = outside | (value < F.lit(rule["min"]))
    if rule.get("max") is not None:
        outside = outside | (value > F.lit(rule["max"]))
    return outside


def _misformatted(df: DataFrame, rule: dict) -> Column:
    column = rule["column"]
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.lit(False)
    parsed = F.try_to_timestamp(F.col(column), F.lit(spark_time_pattern(rule["format"])))
    return F.col(column).isNotNull() & parsed.isNull()


def _measures(df: DataFrame, rule: dict) -> dict[str, Column]:
    """Aggregates of one rule: what was observed, how many values counted, how many failed."""
    kind = rule["rule"]
    rows = F.count(F.lit(1))
    none = F.lit(None).cast("double")
    if kind == "row_count_between":
        return {"observed": rows.cast("double"), "elements": rows,
                "failed": _outside(rows, rule).cast("long")}
    if kind == "columns_superset":
        missing = len([c for c in rule["columns"] if c not in df.columns])
        return {"observed": F.max(F.lit(float(missing))), "elements": rows,
                "failed": F.max(F.lit(missing)).cast("long")}
    value = F.col(rule["column"])
    if kind == "not_null":
        return {"observed": none, "elements": rows, "failed": F.count_if(value.isNull())}
    if kind == "between":
        return {"observed": none, "elements": F.count(value),
                "failed": F.count_if(_outside(value, rule))}
    if kind == "in_set":
        return {"observed": none, "elements": F.count(value),
                "failed": F.count_if(value.isNotNull() & ~value.isin(rule["values"]))}
    if kind == "strftime_format":
        return {"observed": none, "elements": F.count(value),
                "failed": F.count_if(_misformatted(df, rule))}
    if kind == "column_min_between":
        low = F.min(value)
        return {"observed": low.cast("double"), "elements": F.count(value),
                "failed": F.coalesce(_outside(low, rule), F.lit(True)).cast("long")}
    raise ValueError(f"unknown rule {kind!r}")


def _row(dataset: str, position: int, rule: dict, observed, elements, failed, status) -> Column:
    pct = half_even(F.try_divide(failed.cast("double") * 100, elements.cast("double")), 4)
    return F.struct(
        F.lit(dataset).alias("dataset"),
        F.lit(position).cast("long").alias("position"),
        F.lit(rule["rule"]).alias("expectation"),
        F.lit(",".join(_columns(rule))).alias("column"),
        F.lit(_kwargs(rule)).alias("kwargs"),
        observed.cast("double").alias("observed"),
        elements.cast("long").alias("element_count"),
        failed.cast("long").alias("unexpected_count"),
        pct.alias("unexpected_pct"),
        status.alias("status"),
    )


def _status(failed: Column) -> Column:
    return F.when(failed == 0, "PASS").otherwise("FAIL")


def _skipped(dataset: str, position: int, rule: dict, status: str) -> Column:
    null = F.lit(None).cast("long")
    return _row(dataset, position, rule, null, null, null, F.lit(status))


def _uniqueness(df: DataFrame, dataset: str, position: int, rule: dict) -> DataFrame:
    """All rows of a duplicated key count as unexpected; rows with only null keys do not count."""
    keys = _columns(rule)
    keyed = df.select(*keys).na.drop("all")
    groups = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("elements"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed"),
    )
    failed = F.col("failed")
    row = _row(
        dataset, position, rule, F.lit(None), F.col("elements"), failed, _status(failed)
    )
    return totals.select(F.inline(F.array(row)))


def run_suite(df: DataFrame, dataset: str, suite: list[dict]) -> DataFrame:
    """One row per rule. A rule on an absent column is SKIPPED when optional, else it fails."""
    shared, rows, grouped = [], [], []
    for position, rule in enumerate(suite, start=1):
        kind = rule["rule"]
        absent = [c for c in _columns(rule) if c not in df.columns]
        if absent and kind != "columns_superset":
            status = "SKIPPED" if rule.get("optional") else "FAIL"
            rows.append(_skipped(dataset, position, rule, status))
        elif kind in ("unique", "compound_unique"):
            grouped.append(_uniqueness(df, dataset, position, rule))
        else:
            measures = _measures(df, rule)
            shared += [m.alias(f"{name}_{position}") for name, m in measures.items()]
            observed, elements, failed = (F.col(f"{name}_{position}") for name in measures)
            rows.append(_row(dataset, position, rule, observed, elements, failed, _status(failed)))
    parts = list(grouped)
    if rows:
        measured = df.agg(*(shared or [F.count(F.lit(1)).alias("rows")]))
        parts.insert(0, measured.select(F.inline(F.array(*rows))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*RESULT_COLUMNS)


def expectation(df: DataFrame, dataset: str, *rules: dict) -> DataFrame:
    """Single rules outside a suite."""
    return run_suite(df, dataset, list(rules))


def suite_summary(results: DataFrame) -> DataFrame:
    """Per dataset: overall success and how many evaluated rules passed; skipped ones do not count."""
    evaluated = F.count_if(F.col("status") != "SKIPPED")
    passed = F.count_if(F.col("status") == "PASS")
    failed = F.count_if(F.col("status") == "FAIL")
    return results.groupBy("dataset").agg(
        (failed == 0).alias("success"),
        evaluated.alias("evaluated"),
        passed.alias("passed"),
        failed.alias("failed"),
        half_even(
            F.coalesce(F.try_divide(passed.cast("double") * 100, evaluated.cast("double")), F.lit(0.0)), 1
        ).alias("pass_pct"),
    )
