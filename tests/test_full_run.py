"""The whole job on generated data with injected dirt, from the command line."""

import pytest
from pyspark.sql import functions as F

import affinis_job
from affinis.operators.quality import suite_summary
from affinis.plans import full_run
from affinis.sources import generate
from tests.helpers import as_dict


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    ix = generate.generate_interactions(generate.row_numbers(spark, 2000))
    ix.withColumn("rating", F.when(F.col("user_id") == 7, F.lit(None)).otherwise(F.col("rating"))).write.option(
        "header", True
    ).csv(f"{folder}/landed")
    affinis_job.main(
        ["all", "--root", f"{folder}/out", "--interactions", f"{folder}/landed", "--as-of", "2024-03-01 00:00:00",
         "--components", "20"]
    )
    return f"{folder}/out"


def test_counts(spark, root):
    counts = as_dict(full_run.row_counts(full_run.produced(spark, root)), "table", "rows")
    assert (counts["interactions_raw"], counts["products_raw"], counts["quality_results"]) == (2000, 500, 22)
    assert counts["interactions_clean"] == counts["interaction_features"] <= 2000
    raw = full_run.produced(spark, root)["interactions_raw"]
    assert counts["user_features"] == raw.select("user_id").distinct().count()
    assert counts["item_features"] == raw.select("item_id").distinct().count()
    assert counts["item_cooccurrence"] > 0
    assert (counts["feature_registry"], counts["experiment_runs"]) == (3, 2)


def test_failed_rules_are_reported(spark, root):
    summary = suite_summary(spark.read.parquet(f"{root}/quality"))
    assert as_dict(summary, "dataset", "success") == {"interactions": False, "products": True}
    assert as_dict(summary, "dataset", "evaluated") == {"interactions": 12, "products": 10}


def test_logged_metrics(spark, root):
    runs = {r["experiment"]: r["metrics"] for r in full_run.produced(spark, root)["experiment_runs"].collect()}
    svd = runs["svd_collaborative_filtering"]
    assert {"precision@10", "recall@10", "ndcg@10", "explained_variance", "sparsity"} <= set(svd)
    assert svd["train_rows"] + svd["test_rows"] == full_run.produced(spark, root)["interactions_clean"].count()
    assert 0 <= runs["content_based_filtering"]["category_consistency@5"] <= 1


def test_a_step_alone_uses_what_is_written(spark, root):
    full_run.register(spark, root)
    assert full_run.produced(spark, root)["feature_registry"].count() == 6


def test_missing_column_is_refused(spark, root):
    with pytest.raises(ValueError):
        full_run.ingest(spark.createDataFrame([(1, 2)], "user_id BIGINT, item_id BIGINT"), spark.range(1), root)
