"""The registered training-data queries against their SQL, and their columns."""

import pytest

import __spark_entry__ as entry_module
from affinis.llm.oracles import ORACLES
from affinis.llm.queries import QUERIES
from tests.helpers import plan_of
from tools.check_oracles import connect, differences

COLUMNS = {
    "op1_html_blocks": ["page_id", "url", "text", "n_chars"],
    "op2_quality_rules": [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    ],
    "op3_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_warc_bundles": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op6_interpolated_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op7_harmonic_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op8_line_windows": ["doc_id", "text", "n_lines", "n_removed", "n_spans"],
    "op9_jaccard_regions": ["doc_id", "n_shingles", "component_id"],
    "op10_cgk_decontamination": ["doc_id", "item_id", "distance"],
    "op11_importance_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
    "op12_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13_secret_owners": [
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied", "n_open",
    ],
}


def test_every_operator_and_the_pipeline_are_registered():
    assert set(QUERIES) == {*COLUMNS, "pipeline"} and set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    frame = QUERIES[name](spark, sf)
    answer = connect(sf).execute(ORACLES[name])
    assert differences(frame.columns, frame.collect(), [d[0] for d in answer.description], answer.fetchall()) == []


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(ORACLES)))
def test_columns(spark, sf, name):
    assert QUERIES[name](spark, sf).columns == COLUMNS[name]


def test_quality_rules_stay_native(spark, sf):
    plan = plan_of(QUERIES["op2_quality_rules"](spark, sf))
    assert not any(node in plan for node in ("Python", "Pandas", "Arrow", "Cartesian"))
