"""Command line: the whole job, or one of its steps, below one root folder."""

from __future__ import annotations

import argparse

from affinis.functions.columns import nan_to_null
from affinis.plans import full_run
from affinis.session import get_session
from affinis.sources import generate, readers

STEPS = ("ingest", "validate", "prepare", "engineer", "register", "train")


def _interactions(spark, args):
    if not args.interactions:
        return generate.generate_interactions(generate.row_numbers(spark, args.rows))
    if args.interactions.endswith(".parquet"):
        return nan_to_null(spark.read.parquet(args.interactions))
    return readers.accepted(readers.scan_interactions(spark, args.interactions))


def _products(spark, args):
    if not args.products:
        return generate.generate_products(generate.row_numbers(spark, args.items))
    if args.products.endswith(".parquet"):
        return nan_to_null(spark.read.parquet(args.products))
    return readers.scan_products_json(spark, args.products, args.json_arrays)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=("all", *STEPS, "counts"))
    parser.add_argument("--root", required=True)
    parser.add_argument("--interactions", help="CSV files with a header, or *.parquet")
    parser.add_argument("--products", help="JSON files, or *.parquet")
    parser.add_argument("--json-arrays", action="store_true", help="one array per JSON file")
    parser.add_argument("--rows", type=int, default=2_000, help="interactions to generate")
    parser.add_argument("--items", type=int, default=500, help="products to generate")
    parser.add_argument("--as-of", help="reference time, yyyy-MM-dd HH:mm:ss")
    parser.add_argument("--tiebreak", nargs="*", default=[], help="columns that order equal times")
    parser.add_argument("--components", type=int, default=50)
    parser.add_argument("--k", type=int, default=10)
    args = parser.parse_args(argv)

    spark = get_session()
    for step in STEPS if args.step == "all" else (args.step,):
        if step == "ingest":
            full_run.ingest(_interactions(spark, args), _products(spark, args), args.root)
        elif step == "validate":
            full_run.validate(spark, args.root)
        elif step == "prepare":
            full_run.prepare(spark, args.root, args.tiebreak)
        elif step == "engineer":
            full_run.engineer(spark, args.root, args.as_of)
        elif step == "register":
            full_run.register(spark, args.root)
        elif step == "train":
            full_run.train(spark, args.root, args.tiebreak, args.components, args.k)
    if args.step in ("all", "counts"):
        full_run.row_counts(full_run.produced(spark, args.root)).show(truncate=False)


if __name__ == "__main__":
    main()
