import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from affinis.llm import importance
from tests.llm.brute import NASTY, lower, nasty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [(100 + i, " ".join(f"w{(i * k) % 37}" for k in range(15 + i % 20))) for i in range(60)]
ODD = [(300, "\x00a\x7fB\x80c_d"), (301, "x" * 5000), (302, "ÀÉ ſ K İ 一二 3rd don't")]


def features(text):
    w = WORD.findall(lower(text))
    return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def resampled(rows, target, percent=25, least=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for i, text in rows:
        n, f = features(text)
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


def test_equals_plain_python_on_odd_rows(spark):
    plain = spark.createDataFrame(TEXTS + ODD, "doc_id long, text string")
    docs = nasty(spark).unionByName(plain, allowMissingColumns=True)
    target = spark.createDataFrame([(1, "w1 w2 w3 w4"), (2, None), (3, "A tie of rows")], "item_id long, text string")
    found = importance.resample(docs, target)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    expected = resampled(NASTY + TEXTS + ODD, [r.text for r in target.collect()])
    assert Counter(map(tuple, found.collect())) == expected
    assert sum(v for k, v in expected.items() if k[4]) > 10


def test_repeated_documents_take_ranks_of_their_own(spark):
    rows = [(5, "same words here " * 10)] * 40 + [(None, "no id " * 20)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = importance.resample(docs, docs.select("text"), percent=50).collect()
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 23)) and len(found) == 44


def test_empty_tables(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert importance.resample(docs.limit(0), docs).collect() == []
    assert Counter(map(tuple, importance.resample(docs, docs.limit(0)).collect())) == resampled(TEXTS, [])


def test_target_like_documents_weigh_more(spark):
    rows = [(i, f"alpha beta gamma {i} " * 10 if i % 2 else f"omega psi chi {i} " * 10) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("alpha beta gamma " * 50,)], "text string")
    found = importance.resample(docs, target).collect()
    like, unlike = ([r.weight for r in found if r.doc_id % 2 == k] for k in (1, 0))
    assert min(like) > max(unlike)


def test_words_have_character_offsets_and_buckets_survive_a_full_cache(monkeypatch):
    f = importance.Features()
    text = "É one\tTwo,three"
    assert all(lower(text)[a:b] == w for w, (a, b) in f.words(text.encode()))
    long_text = " ".join(f"q{i % 50} é{i}" for i in range(400))
    n, whole = f.buckets(long_text.encode())
    monkeypatch.setattr(importance, "CACHED_WORDS", 7)
    assert importance.Features().buckets(long_text.encode()) == (n, whole)
    assert Counter(np.frombuffer(whole, np.uint16).tolist()) == Counter(features(long_text)[1])
