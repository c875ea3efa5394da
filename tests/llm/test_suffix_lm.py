import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from affinis.llm import interpolated_lm, suffix_dedup
from affinis.llm.common import table
from affinis.llm.textscan import word_hashes
from tests.llm.brute import NASTY, lower, nasty, words

SIZE = 200


def remove_repeats(rows, keep="none", size=SIZE):
    texts = [(t or "").encode() for _, t in rows]
    seen, first = Counter(), {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] or 0))
    for k in order:
        for p in range(len(texts[k]) - size + 1):
            s = texts[k][p : p + size]
            seen[s] += 1
            first.setdefault(s, (k, p))
    out = []
    for k, (i, _) in enumerate(rows):
        gone = np.zeros(len(texts[k]), dtype=bool)
        for p in range(len(texts[k]) - size + 1):
            s = texts[k][p : p + size]
            if seen[s] > 1 and (keep == "none" or first[s] != (k, p)):
                gone[p : p + size] = True
        left = bytes(b for b, g in zip(texts[k], gone) if not g)
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out.append((i, len(texts[k]), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return Counter(out)


def passages():
    draw = random.Random(3)
    words_ = ["".join(draw.choices("abcdefgé", k=draw.randint(2, 8))) for _ in range(300)]
    text = lambda n: " ".join(draw.choices(words_, k=n))
    shared, other = text(70), text(60)
    rows = [(i, text(20) + " " + (shared if i % 3 else other) + " " + text(25)) for i in range(24)]
    rows += [(100, rows[0][1]), (101, rows[1][1][:-7] + "x"), (102, shared[: len(shared) // 2] + text(40)), (103, "ab" * 400), (104, text(9))]
    rows += [(105, "ab" * 150 + text(50)), (106, shared + " - " + shared), (107, None), (108, "")]
    return rows


@pytest.mark.parametrize("bucket", [suffix_dedup.BUCKET, 3])
def test_all_copies_go(spark, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rows = passages()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int").repartition(5)
    assert Counter(map(tuple, suffix_dedup.dedup(docs).collect())) == remove_repeats(rows)
    assert suffix_dedup.dedup(docs.limit(0)).collect() == []


@pytest.mark.parametrize("bucket", [suffix_dedup.BUCKET, 3])
def test_first_copies_stay(spark, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.dedup(docs, keep="first", with_text=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == remove_repeats(rows, "first")
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_odd_documents(spark):
    rows = [(i, t[:3000] if t else t) for i, t in NASTY]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, suffix_dedup.dedup(docs).collect())) == remove_repeats(rows)


def test_given_documents(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, suffix_dedup.dedup(docs).collect())) == remove_repeats(rows)


def test_word_hashes_tell_words_apart():
    texts = [t.encode() for _, t in NASTY if t]
    found, counts = word_hashes(texts, block=50)
    plain = [lower(w) for t in texts for w in words(t.decode())]
    assert counts.tolist() == [len(words(t.decode())) for t in texts]
    assert len(set(zip(plain, found.tolist()))) == len(set(plain)) == len(set(found.tolist()))


def check_scores(found, rows):
    train = [(i, t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    one = Counter(w for _, t in train for w in [*words(lower(t)), None])
    n, v = sum(one.values()), len(one)
    expected = Counter()
    for i, t in rows:
        w = [*words(lower(t)), None]
        base = sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w)
        expected[i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(w), sum(x in one for x in w), n, f"{base:.6e}"] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6e}") for r in found) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_base_scores_and_odd_rows(spark):
    docs = nasty(spark)
    check_scores(interpolated_lm.score(docs).collect(), NASTY)
    assert interpolated_lm.score(docs.limit(0)).collect() == []
    alone = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][:1]
    only = spark.createDataFrame([(alone[0], "held out only")], "doc_id long, text string")
    assert interpolated_lm.score(only).first().train_tokens == 0


def test_model_beats_its_base_on_held_out_documents(spark, monkeypatch):
    monkeypatch.setattr(interpolated_lm, "UNIT", 60_000)  # several units
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = interpolated_lm.score(docs).collect()
    check_scores(found, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)


def test_weights_are_distributions():
    cells = np.array([(3 * 320 + 50) * 320 + 10, (3 * 320 + 60) * 320 + 0, 40 * 320])
    w = interpolated_lm.learn_weights(cells, np.array([90.0, 10.0, 5.0]), 1e-4)
    assert np.allclose(w.sum(axis=1), 1) and (w >= 0).all() and w[3, 2] > 0.8 and w[0, 2] == 0


def test_totals_beyond_32_bits():
    keys = np.array([5, 9, 2**63 + 1], dtype=np.uint64)
    most = np.array([2**32 - 1, 0, 7], dtype=np.uint32)
    asked = pa.table(
        {
            "kind": [0, 0, 0],
            "unit": [1, 2, 3],
            "bucket": [0, 0, 0],
            "keys": [interpolated_lm._gaps(keys)] * 3,
            "counts": [interpolated_lm._zip(most)] * 3,
        }
    )
    found = interpolated_lm._answer(asked).to_pylist()
    for row in found[:3]:
        assert interpolated_lm._unzip(row["counts"], np.int64).tolist() == [3 * (2**32 - 1), 0, 21]
    assert (found[3]["unit"], found[3]["n"], found[3]["v"]) == (-1, 3 * (2**32 - 1) + 21, 2)
