import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from affinis.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain Python, one vector part at a time."""
    kept = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return Counter()
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    size = width // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * size : (p + 1) * size] for r in first] for p in range(parts)]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, w)), e) for e, w in enumerate(books[p]))

    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = {}
            for v in cut:
                members.setdefault(near(p, v[p])[1], []).append(v[p])
            new.append([[sum(c) // len(c) for c in zip(*members[e])] if e in members else w for e, w in enumerate(books[p])])
        books = new
    found = [[near(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    per_label = Counter()
    for (_, _, label), e in zip(kept, errors):
        per_label[label] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for w in b for x in w).encode()).hexdigest()
    return Counter(
        (i, "".join(f"{e:02x}" for _, e in f), err, per_label[label], sha) for (i, _, label), f, err in zip(kept, found, errors)
    )


def vectors(n, dims, seed=1):
    draw = random.Random(seed)
    return [(i * 3, [draw.choice([0.0, 0.25, -0.5, draw.uniform(-1, 1)]) for _ in range(dims)], draw.choice([0, 0, 0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("n,dims,block", [(150, 32, 4096), (90, 16, 7), (20, 32, 4096)])
def test_equals_plain_python(spark, monkeypatch, n, dims, block):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", block)
    rows = [(i, np.array(v, np.float32).tolist(), k) for i, v, k in vectors(n, dims)]
    found = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, found.collect())) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(40, 20)
    rows += [(1, None, 0), (2, [None, 1.0], 1), (4, [float("nan")] * 20, 1), (5, [float("inf")] + [0.0] * 19, 1)]
    rows += [(7, [], 2), (8, [1.5], None), (None, [0.5] * 20, 1), (3, [0.125] * 20, 1), (3, [0.125] * 20, 1), (3, [-0.125] * 20, 0)]
    rows += [(10, [1000.0] * 33, 9)]
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", n string, fact_key int")
    assert Counter(map(tuple, vector_codes.compress(docs).collect())) == brute(rows)


def test_hot_label_and_empty_table(spark):
    rows = [(i, v, 1) for i, v, _ in vectors(60, 16)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert Counter(map(tuple, vector_codes.compress(table).collect())) == brute(rows)
    assert vector_codes.compress(table.limit(0)).collect() == []
    assert vector_codes.compress(table.limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_too_large_components_raise(spark):
    table = spark.createDataFrame([(1, [1e30], 1)], SCHEMA)
    with pytest.raises(Exception, match="exceeds"):
        vector_codes.compress(table)


def test_table_gathers_equal_direct_distances():
    draw = np.random.default_rng(3)
    rows, books = draw.integers(-300, 300, (500, 32)), draw.integers(-300, 300, (16, 64, 2))
    index, distance = vector_codes.Block(*vector_codes._coded(rows), 500, 32).nearest(books)
    direct = ((rows.reshape(500, 16, 1, 2) - books[None]) ** 2).sum(axis=3)
    assert (index.T == direct.argmin(axis=2)).all() and (distance.T == direct.min(axis=2)).all()
