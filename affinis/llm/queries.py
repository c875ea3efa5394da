"""The registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from affinis.llm import (
    cgk_decontam,
    html_blocks,
    importance,
    interpolated_lm,
    jaccard_regions,
    line_dedup,
    packing,
    quality_rules,
    secrets,
    suffix_dedup,
    token_files,
    vector_codes,
    warc,
)
from affinis.llm.common import table
from affinis.llm.oracles import ORACLES as ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = "word_bpe_49k.json"


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_html_blocks(spark, sf):
    return html_blocks.extract(table(spark, sf, "pages"))


@query
def op2_quality_rules(spark, sf):
    found = quality_rules.assess(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op3_token_files(spark, sf):
    return token_files.token_round_trip(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)


@query
def op4_suffix_dedup(spark, sf):
    return suffix_dedup.dedup(table(spark, sf, "documents"), keep="none")


@query
def op5_warc_bundles(spark, sf):
    found = warc.warc_round_trip(table(spark, sf, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_interpolated_lm(spark, sf):
    return interpolated_lm.score(table(spark, sf, "documents"))


@query
def op7_harmonic_packing(spark, sf):
    return packing.pack(packing.pieces(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), end_id=2))


@query
def op8_line_windows(spark, sf):
    return line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"), report=True)


@query
def op9_jaccard_regions(spark, sf):
    return jaccard_regions.link_documents(table(spark, sf, "documents"))


@query
def op10_cgk_decontamination(spark, sf):
    return cgk_decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op11_importance_resampling(spark, sf):
    return importance.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op12_vector_codes(spark, sf):
    return vector_codes.compress(table(spark, sf, "embeddings"))


@query
def op13_secret_owners(spark, sf):
    return secrets.scan_documents(table(spark, sf, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
