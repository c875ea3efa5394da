"""From raw documents to packed token sequences: five stages, each one operator over all that the stage before kept.

Every stage's result is written as Parquet below the shared folder and read again as the next one's documents. All but the last
return the columns of `documents`; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import cgk_decontam, jaccard_regions, line_dedup, packing, quality_rules
from affinis.llm.common import table
from affinis.session import drop_folder, scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or whose host does, go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line windows go; `n_chars` follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similarity the one with the smallest id stays."""
    return jaccard_regions.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return cgk_decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, cut and packed."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Tokenizer ids and edit distance have no SQL form; tests/llm/test_pipeline.py runs every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        if last:
            drop_folder(spark, last)
        docs, last = spark.read.parquet(folder), folder
    return docs
