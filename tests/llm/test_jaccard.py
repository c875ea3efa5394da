import random
from collections import Counter

import numpy as np
import pytest

from affinis.llm import jaccard_regions
from affinis.llm.common import table
from affinis.llm.components import components
from tests.llm.brute import NASTY, lower, nasty, words


def shingles(text):
    w = words(lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def link(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    near = {(a, b) for v in where.values() for i, a in enumerate(v) for b in v[i + 1 :]}
    for a, b in near:
        common = len(sets[a] & sets[b])
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            parent[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return Counter((i, len(sets[k]), least.get(find(k), i)) for k, (i, _) in enumerate(rows))


def groups():
    """A large group of near copies of a text, chains of edits, shared passages, and texts apart."""
    draw = random.Random(11)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 6))) for _ in range(400)]
    text = lambda n: draw.choices(vocabulary, k=n)
    rows, base, passage = [], text(90), text(30)
    for i in range(150):
        w = list(base)
        for _ in range(draw.randint(0, 6)):
            w[draw.randrange(len(w))] = draw.choice(vocabulary)
        rows.append((i, " ".join(w)))
    chain = text(60)
    for i in range(200, 230):
        chain = list(chain)
        chain[draw.randrange(60)] = draw.choice(vocabulary)
        rows.append((i, " ".join(chain)))
    rows += [(i, " ".join(text(25) + passage + text(25))) for i in range(300, 360)]
    rows += [(400, rows[0][1]), (401, rows[0][1].upper()), (402, None), (403, ""), (404, "a b"), (405, "A b"), (406, "a b c"), (407, "x y z v w")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("cell, chunk", [(jaccard_regions.CELL, jaccard_regions.CHUNK), (16, 100)])
def test_components_match_brute_force(spark, monkeypatch, cell, chunk):
    monkeypatch.setattr(jaccard_regions, "CELL", cell)
    monkeypatch.setattr(jaccard_regions, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_regions, "UNIT", 20_000)
    rows = groups()
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, node string").repartition(3)
    assert Counter(map(tuple, jaccard_regions.link_documents(docs).collect())) == link(rows)


def test_cells_hold_every_pair_of_a_block_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_regions, "CELL", 8)
    name = lambda k: k.to_bytes(16, "big")
    blocks = spark.createDataFrame([(s, name(k), 10, name(k)) for s in (1, 2) for k in range(40 * s)], "shingle long, node binary, n long, root binary")
    sets = spark.createDataFrame([(name(k), bytes(8 * jaccard_regions.SIGNATURE)) for k in range(80)], "node binary, signature binary")
    known = spark.createDataFrame([(name(k), name(99), 0.5 if k % 2 else 1.0) for k in range(10)], "node binary, pivot binary, near double")
    found = jaccard_regions._all_pairs(jaccard_regions._cells(blocks, known, sets)).collect()
    # Members around one pivot meet only within a window of its distances.
    expected = {(a, b) for a in range(80) for b in range(a + 1, 80) if not (b < 10 and (a - b) % 2)}
    assert Counter((int.from_bytes(r.u, "big"), int.from_bytes(r.v, "big")) for r in found) == Counter(expected)
    near = jaccard_regions._nearest(jaccard_regions._cells(blocks, known, sets)).collect()
    assert len(near) <= 80 and {int.from_bytes(x, "big") for r in near for x in (r.u, r.v)} == set(range(80))


def test_near_copies_are_tested_in_proportion_to_their_number(spark, monkeypatch):
    tested = []
    measure = jaccard_regions._distances
    monkeypatch.setattr(jaccard_regions, "_distances", lambda pairs, sets: (tested.append(pairs.count()), measure(pairs, sets))[1])
    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(draw.randint(0, 8)):
            w[draw.randrange(200)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    found = jaccard_regions.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, found)) == link(rows)
    assert sum(tested) <= 2 * len(rows)


def test_given_documents(spark, sf):
    docs = table(spark, sf, "documents")
    assert Counter(map(tuple, jaccard_regions.link_documents(docs).collect())) == link([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_documents(spark):
    docs = nasty(spark)
    found = jaccard_regions.link_documents(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, found.collect())) == link(NASTY)
    assert jaccard_regions.link_documents(docs.limit(0)).collect() == []


def test_signature_never_exceeds_the_difference():
    draw = np.random.default_rng(1)
    for _ in range(50):
        x = draw.integers(0, 2**63, 300, dtype=np.uint64)
        y = np.concatenate([x[draw.integers(0, 60) :], draw.integers(0, 2**63, draw.integers(0, 60), dtype=np.uint64)])
        apart = np.bitwise_count(jaccard_regions.signature(x) ^ jaccard_regions.signature(y)).sum()
        assert apart <= len(np.setxor1d(x, y))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(149, 200)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 50)}, 200: 100}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_rounds_are_written_by_as_many_tasks_as_their_rows_need(spark):
    j, name = jaccard_regions, "spark.sql.adaptive.coalescePartitions.enabled"
    sets = [(str(k).encode(), 1, j._gaps(x), j.sketch(x).tobytes()) for k in range(400) for x in [np.array([k + 1], np.uint64)]]
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        assert len(components(spark.range(400).selectExpr("id + id % 7 + 1 AS u", "id AS v")).inputFiles()) == 1
        sets = spark.createDataFrame(sets, "node binary, n long, shingles binary, sketch binary")
        pairs = sets.selectExpr("node AS u", "node AS v").repartition(8)
        found = j._distances(pairs, sets)
        assert found.where("common = 1 AND total = 1").count() == 400
        assert len(found.inputFiles()) == 1
    finally:
        spark.conf.set(name, before)


def test_sketches_tell_large_sets_apart_and_lose_no_link():
    j, draw = jaccard_regions, np.random.default_rng(2)
    for n in (1, 40, 700, 3000):
        x, y = (np.unique(draw.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(2))
        for z in (y, x[: n - n // 10], np.concatenate([x[n // 5 :], y[: n // 2]]), y[: n // 3]):
            assert j.sketches_apart(j.sketch(x), j.sketch(z)) <= len(np.setxor1d(x, z))
    limit = (100 - j.PERCENT) * 2 * 3000 // (100 + j.PERCENT)
    assert j.sketches_apart(j.sketch(x), j.sketch(y)) > limit >= np.bitwise_count(j.signature(x) ^ j.signature(y)).sum()


def test_sets_of_pairs_that_are_apart_are_not_measured(spark):
    j, draw = jaccard_regions, np.random.default_rng(3)
    x, y = (np.unique(draw.integers(0, 2**63, 3000, dtype=np.uint64)) for _ in range(2))
    rows = [(k, len(s), j._gaps(s), j.sketch(s).tobytes()) for k, s in ((b"a", x), (b"b", y), (b"c", x[50:]))]
    sets = spark.createDataFrame(rows, "node binary, n long, shingles binary, sketch binary")
    pairs = spark.createDataFrame([(b"a", b"b"), (b"a", b"c"), (b"b", b"c")], "u binary, v binary")
    found = {(bytes(r.u), bytes(r.v)): (r.common, r.total) for r in j._distances(pairs, sets).collect()}
    assert found == {(b"a", b"b"): (None, None), (b"b", b"c"): (None, None), (b"a", b"c"): (2950, 3000)}


def test_parts_of_a_deal_hold_each_row_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_regions, "CELL", 8)
    monkeypatch.setattr(jaccard_regions, "CHUNK", 10)
    name = lambda k: k.to_bytes(16, "big")
    blocks = spark.createDataFrame([(1, name(k), 10, name(k)) for k in range(80)], "shingle long, node binary, n long, root binary")
    sets = spark.createDataFrame([(name(k), bytes(8 * jaccard_regions.SIGNATURE)) for k in range(80)], "node binary, signature binary")
    known = spark.createDataFrame([], "node binary, pivot binary, near double")
    parts = []
    for deal in (1, 2):
        own = jaccard_regions._cells(blocks, known, sets, deal).where("i = j")
        parts.append({r.node: r.i for r in own.collect()})
        assert own.count() == len(parts[-1]) == 80
        assert jaccard_regions._nearest(own).count() <= 80
    assert parts[0] != parts[1]
