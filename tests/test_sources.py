import json

import pytest
from pyspark.sql import functions as F

from affinis.operators.features import user_features
from affinis.sources import checks, generate, readers, runs, writers
from affinis.sources.feature_store import FEATURE_DEFS, FeatureStore, infer_feature_defs
from tests.helpers import as_dict, as_set, plan_of


def test_csv_keeps_lines_that_do_not_fit_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "user_id,item_id,rating,timestamp,event_type\n1,2,3.5,2024-01-01 00:00:00,view\n"
        "x,2,3.5,2024-01-01 00:00:00,view\n3,,NaN,bad,\n"
    )
    read = readers.scan_interactions(spark, str(tmp_path)).cache()
    assert as_set(readers.accepted(read), "user_id", "item_id", "rating", "timestamp", "event_type") == {
        (1, 2, 3.5, "2024-01-01 00:00:00", "view"), (3, None, None, "bad", None),
    }
    assert [r[readers.CORRUPT] for r in readers.rejected(read).collect()] == ["x,2,3.5,2024-01-01 00:00:00,view"]


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user_id,item_id,rating,timestamp,event_type\n1,2,3.5,t1,view\n1,2\n,7,nan,,\n")
    (tmp_path / "b.csv").write_bytes(
        b"\xef\xbb\xbfrating, item_id,timestamp,user_id,note\r\n4.0,3.0,\"t, 2\",5.0,x\r\n\r\n4.0,3.5,t,5,x\r\n9,1e3,t3,6,\r\n"
    )
    (tmp_path / "c.csv").write_text("user_id,item_id,rating,timestamp\n")
    read = readers.scan_interactions(spark, str(tmp_path))
    assert as_set(readers.accepted(read)) == {
        (1, 2, 3.5, "t1", "view"), (None, 7, None, None, None), (5, 3, 4.0, "t, 2", None), (6, 1000, 9.0, "t3", None),
    }
    assert as_set(readers.rejected(read)) == {("1,2", "fields"), ("4.0,3.5,t,5,x", "item_id")}
    assert readers.rejected(read).count() == 2  # without reading the columns
    assert as_set(readers.reject_counts(read)) == {("fields", 1), ("item_id", 1)}


def test_a_line_is_parsed_once_and_casts_that_cannot_fit_are_not_tried(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user_id,item_id,rating,timestamp\n1, 2 ,1e1,t\n+3,-4.00,many,t\n5,6,2.5x,t\n7,8,0x1p1,t\n9,9,-Inf,t\n")
    (tmp_path / "b.csv").write_text("rating,item_id,user_id,timestamp,note\n.5,1e2,4.,t,\nNaN,12345678901234567890,1,t,\n1d,1.5,2,t,\n")
    read = readers.scan_interactions(spark, str(tmp_path))
    assert as_set(readers.accepted(read), "user_id", "item_id", "rating") == {
        (1, 2, 10.0), (7, 8, 2.0), (9, 9, float("-inf")), (4, 100, 0.5),
    }
    assert as_set(readers.reject_counts(read)) == {("rating", 2), ("item_id", 2)}
    for asked in (readers.accepted(read), readers.rejected(read), readers.reject_counts(read)):
        assert asked._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 2  # one for each number of fields


def test_a_header_without_required_columns_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user_id,item_id,rating\n1,2,3.5\n")
    with pytest.raises(ValueError, match="timestamp"):
        readers.scan_interactions(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text("")
    assert readers.accepted(readers.scan_interactions(spark, str(tmp_path))).collect() == []


def test_json_array_of_mixed_shapes(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        json.dumps(
            [
                {"id": 1, "title": "a", "price": 9.5, "category": "x", "rating": {"rate": 3.9, "count": 120}},
                {"item_id": 2, "rating": 4.5, "rating_count": 7, "in_stock": False, "brand": "B"},
                {"item_id": 3, "price": "oops", "rating": {"count": 2}},
                {"item_id": 4, "rating": {"rate": 2.0}, "rating_count": 9},
            ]
        )
    )
    found = readers.scan_products_json(spark, str(tmp_path), arrays=True)
    assert as_set(found) == {
        (1, "a", "x", "unknown", 9.5, 3.9, 120, True),
        (2, "", "unknown", "B", 0.0, 4.5, 7, False),
        (3, "", "unknown", "unknown", None, None, 2, True),
        (4, "", "unknown", "unknown", 0.0, 2.0, 9, True),
    }


def test_latest_snapshot_prunes_older_ones(spark, tmp_path):
    path = str(tmp_path / "s")
    for n, name in enumerate(["20240101_000000", "20240102_000000"]):
        writers.write_raw_snapshot(spark.range(3).withColumn("n", F.lit(n)), path, "parquet", name)
    latest = readers.scan_latest_snapshot(spark, path)
    assert as_set(latest, "n", "ingest_ts") == {(1, "20240102_000000")} and latest.count() == 3
    # Older snapshots are not even listed, so the plan needs no search for the newest.
    assert all("ingest_ts=20240102_000000/" in f for f in latest.inputFiles()) and "Subquery" not in plan_of(latest)
    assert writers.snapshot_name() < writers.snapshot_name()


def test_ingest_checks(spark):
    df = spark.createDataFrame(
        [(1, 1, None), (1, 1, None), (None, 1, "t"), (None, 1, "t"), (2, 2, "t")],
        "user_id BIGINT, item_id BIGINT, timestamp STRING",
    )
    assert checks.missing_columns(df) == ["rating"]
    assert as_set(checks.require_columns(df)) == {
        ("user_id", True, 3), ("item_id", True, 5), ("rating", False, 0), ("timestamp", True, 3),
    }
    assert checks.null_counts(df, ["user_id", "timestamp"]).first()[0] == 4
    assert checks.duplicate_key_count(df).first()[0] == 2


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_checksum_does_not_depend_on_order_but_on_content(spark, method):
    df = spark.range(1000).withColumn("v", F.col("id") * 1.5)
    same = checks.table_checksum(df.repartition(7).orderBy(F.desc("v")), method)
    assert checks.table_checksum(df, method).first() == same.first()
    changed = df.withColumn("v", F.when(F.col("id") == 5, 0.0).otherwise(F.col("v")))
    assert checks.table_checksum(changed, method).first() != same.first()
    assert checks.table_checksum(df.limit(0), method).first()["rows"] == 0


def test_generated_tables_do_not_depend_on_partitions(spark):
    rows = generate.row_numbers(spark, 3000)
    df = generate.generate_interactions(rows)
    assert as_set(df) == as_set(generate.generate_interactions(rows.repartition(13)))
    bounds = df.agg(
        F.min("user_id"), F.max("user_id"), F.min("item_id"), F.max("item_id"), F.min("rating"), F.max("rating")
    ).first()
    assert tuple(bounds) == (1, 200, 1, 500, 1.0, 5.0)
    shares = as_dict(df.groupBy("event_type").count(), "event_type", "count")
    for name, share in generate.EVENT_SHARES:
        assert shares[name] / 3000 == pytest.approx(share, abs=0.03)
    assert df.agg(F.min("timestamp"), F.max("timestamp")).first()[0] == "2024-01-01 00:00:00"
    items = generate.generate_products(generate.row_numbers(spark, 600))
    assert items.select("item_id").distinct().count() == 600
    assert items.select("category").distinct().count() == 6 and items.select("brand").distinct().count() == 5
    assert items.filter("price < 5 OR price > 999 OR rating_count < 5 OR rating_count > 4999").isEmpty()
    assert as_set(generate.generate_products(generate.row_numbers(spark, 5), seed=1)) != as_set(items.filter("item_id <= 5"))


IX = "user_id BIGINT, item_id BIGINT, rating DOUBLE, timestamp STRING, event_type STRING"


def test_feature_tables_are_replaced_and_keys_checked(spark, tmp_path):
    df = spark.createDataFrame([(u, 1, 2.0, "2024-01-01 00:00:00", "view") for u in range(5)], IX)
    users = user_features(df, "2024-02-01 00:00:00")
    root = str(tmp_path)
    writers.write_feature_tables({"user_features": users}, root)
    writers.write_feature_tables({"user_features": users.filter("user_id < 3")}, root)
    back = readers.read_feature_table(spark, root, "user_features")
    assert back.count() == 3 and back.schema.names == users.columns
    with pytest.raises(ValueError):
        writers.write_feature_tables({"user_features": users.unionAll(users)}, root)


def test_feature_store_versions(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "fs"))
    with pytest.raises(KeyError):
        store.read("users")
    assert store.list_groups().count() == 0
    first = spark.createDataFrame([(1, 2.0), (2, 3.0)], "user_id BIGINT, score DOUBLE")
    defs = infer_feature_defs(first)
    assert defs == [("user_id", "bigint", "user_id"), ("score", "double", "score")]
    a = store.write("users", first, defs, "src", "d", "user_id")
    b = store.write("users", first.limit(1), defs, "src", "d", "user_id")  # within the same second
    assert a != b
    assert [r["version"] for r in store.list_versions("users").collect()] == [a, b]
    assert store.read("users").count() == 1 and store.read("users", a).count() == 2
    assert store.read("users", a, ["score"]).columns == ["score"]
    with pytest.raises(KeyError):
        store.read("users", "v0")
    c = store.write("users", first.withColumn("score", F.col("score") * 2), defs, "src", "d", "user_id", a)
    assert c == a  # the same version again replaces it
    assert as_set(store.read("users", a), "score") == {(4.0,), (6.0,)}
    entry = store.get_version("users", b).first()
    assert (entry["rows"], entry["cols"], entry["columns"]) == (1, 2, ["user_id", "score"])
    assert store.get_latest("users").first()["version"] == a
    assert len(entry["checksum"]) == 12


def test_checksum_in_registry_follows_content(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "fs"))
    df = spark.range(50)
    store.write("a", df, [], "s", "d", "id", "v1")
    store.write("a", df.repartition(5), [], "s", "d", "id", "v2")
    store.write("a", df.filter("id <> 3"), [], "s", "d", "id", "v3")
    sums = as_dict(store.registry(), "version", "checksum")
    assert sums["v1"] == sums["v2"] != sums["v3"]


def test_online_lookup_is_pushed_into_the_scan(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "fs"))
    store.write("a", spark.range(50).toDF("user_id"), [], "s", "d", "user_id")
    found = store.online_lookup("a", [3, 4, 99], "user_id")
    assert as_set(found) == {(3,), (4,)}
    assert "PushedFilters: [In(user_id" in plan_of(found)


def test_declared_features(spark, tmp_path):
    assert [len(v) for v in FEATURE_DEFS.values()] == [8, 6, 5]
    store = FeatureStore(spark, str(tmp_path / "fs"))
    for name, defs in FEATURE_DEFS.items():
        store.write(name, spark.range(1), defs, "s", "d", "id")
    store.write("user_features", spark.range(1), FEATURE_DEFS["user_features"], "s", "d", "id")
    assert store.feature_catalog().count() == 19
    assert store.feature_catalog(latest_only=False).count() == 27
    assert as_set(store.list_groups()) == {("user_features",), ("item_features",), ("interaction_features",)}


def test_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert runs.read_runs(spark, path).count() == 0
    runs.log_run(spark, path, "e", {"m@10": 0.12345678, "n": 3}, {"k": 10}, {"t": "x"})
    last = runs.log_run(spark, path, "e", spark.createDataFrame([(0.1,)], "`m@10` DOUBLE"))
    runs.log_run(spark, path, "f", {}, status="FAILED")
    logged = {r["run_id"]: r for r in runs.read_runs(spark, path).collect()}
    assert len(logged) == 3
    assert logged[last]["metrics"] == {"m@10": 0.1} and logged[last]["params"] == {}
    compared = {(r["experiment"], r["metric"]): r for r in runs.compare_runs(runs.read_runs(spark, path)).collect()}
    row = compared[("e", "m@10")]
    assert (row["runs"], row["latest_value"], row["best_value"]) == (2, 0.1, 0.123457)
    assert row["best_run"] != last


def test_checksum_sees_which_column_is_null(spark):
    schema = "a long, b long"
    left = spark.createDataFrame([(None, 5), (1, 2)], schema)
    right = spark.createDataFrame([(5, None), (1, 2)], schema)
    for method in ("xxhash64", "md5"):
        assert checks.table_checksum(left, method).first() != checks.table_checksum(right, method).first()
    texts = [spark.createDataFrame([r], "a string, b string") for r in (("x|y", "z"), ("x", "y|z"), ("~", None), (None, "~"))]
    assert len({checks.table_checksum(t, "md5").first() for t in texts}) == 4


def test_latest_snapshot_reads_its_own_files(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    for name in ("s1", "s2"):
        writers.write_raw_snapshot(spark.range(3).withColumn("n", F.lit(name)), path, "parquet", name)
    latest = readers.scan_latest_snapshot(spark, path)
    assert {(r.n, r.ingest_ts) for r in latest.collect()} == {("s2", "s2")}
    assert latest.inputFiles() and all("ingest_ts=s2" in f for f in latest.inputFiles())


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([(1, 2)], "user_id long, total_interactions long")
    writers.write_feature_tables({"user_features": good}, root)
    with pytest.raises(ValueError, match="not unique"):
        writers.write_feature_tables({"user_features": good.union(good)}, root)
    assert readers.read_feature_table(spark, root, "user_features").count() == 1
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["user_features"]


def test_package_reaches_workers_from_another_folder(tmp_path):
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from affinis.session import get_session
from affinis.operators.svd import truncated_svd
spark = get_session('elsewhere', 'local[2]', **{{'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '2'}})
model = truncated_svd(spark.createDataFrame([(1, 1, 2.0), (2, 2, 1.0)], 'user_id long, item_id long, rating double'), 1)
print('sigma', float(model.singular_values[0]))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "sigma 2.0" in out.stdout, out.stderr[-2000:]
