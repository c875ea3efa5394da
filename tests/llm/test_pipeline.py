from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from affinis.llm import cgk_decontam
from affinis.llm.common import table
from tests.llm.brute import nasty
from tests.llm.test_jaccard import link
from tests.llm.test_quality_lines import dedup, stats


def plain_run(docs, items):
    """docs: (doc_id, text); good hosts only. Returns the kept documents."""
    kept = []
    for i, t in docs:
        n, _, symbols, _, repeats = stats(t)
        if n >= 10 and 100 * repeats <= 20 * n and 100 * symbols <= 10 * n:
            kept.append((i, t))
    new = dedup(kept)
    kept = [(i, new[i, t][0]) for i, t in kept]
    kept = [(i, t) for i, t in kept if {c for d, _, c in link(kept) if d == i} == {i}]
    found = {d for d, _, _ in cgk_decontam.matches(cgk_decontam.Items(items), [t.encode() for _, t in kept])}
    return [r for k, r in enumerate(kept) if k not in found]


def test_stages_match_plain_python(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, cgk_decontam.normal(r.text.encode())) for r in table(spark, sf, "benchmark").collect()]
    kept = plain_run(docs, items)
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter({i: len(coder.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept})
    found = Counter()
    for r in corpus_pipeline.run(spark, sf).collect():
        found[r.doc_id] += r.length
    assert found == expected


def test_each_stage_on_odd_documents(spark, sf):
    odd = nasty(spark).selectExpr("doc_id", "text", "'en' AS lang", "source", "length(text) AS n_chars", "key_id")
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            rows = out.collect()
            assert name == "packing" or out.columns == docs.columns
            assert docs is odd or not rows
    ids = Counter(r.doc_id for r in corpus_pipeline.near_duplicates(spark, odd, sf).collect())
    assert ids[6] == 1 and ids[1] == ids[2] == ids[3] == ids[None] == 1


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "packing"]
