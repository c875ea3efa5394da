"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and cores.
Each query is built and fully computed once, after one unmeasured warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from affinis.plans.queries import QUERIES  # noqa: E402
from affinis.session import get_session  # noqa: E402

HEADLINE = [
    "clean_interactions",
    "clean_products",
    "encode_products",
    "user_features",
    "item_features",
    "interaction_features",
    "item_cooccurrence",
    "item_jaccard",
    "user_rating_gap",
    "dedup_keep_first",
    "temporal_holdout_split",
    "popularity_rank",
    "run_suite",
    "evaluate_recommendations",
    "item_similarity_top_n",
    "truncated_svd",
    "recommend_top_k",
    "train_svd_model",
    "train_content_model",
    "eda_summary",
    "price_box_stats",
    "fs_write",
    "fs_online_lookup",
    "write_feature_tables",
    "end_to_end_row_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["user_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(found.group(1)) if found else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
