"""Factors, tiles and recommendations against numpy on small matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.functions import tiles
from affinis.functions.tiles import top_candidates
from affinis.operators import recommend, svd
from affinis.session import pin
from tests.helpers import as_dict, as_set


def ratings_of(spark, matrix):
    cells = [(int(u) + 100, int(i) + 7, float(matrix[u, i])) for u, i in zip(*np.nonzero(matrix))]
    return spark.createDataFrame(cells, "user_id BIGINT, item_id BIGINT, rating DOUBLE")


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(3)
    full = np.round(rng.uniform(1, 5, (60, 24)), 1)
    return np.where(rng.uniform(size=full.shape) < 0.35, full, 0.0)


def product(model, n_users, n_items):
    users = {r["user_id"] - 100: r["vector"] for r in model.user_factors.collect()}
    items = {r["item_id"] - 7: r["vector"] for r in model.item_factors.collect()}
    width = len(model.singular_values)
    u = np.array([users.get(i, [0.0] * width) for i in range(n_users)])
    v = np.array([items.get(i, [0.0] * width) for i in range(n_items)])
    return u @ v.T


@pytest.mark.parametrize("k", [1, 8, 50])
def test_exact_factors(spark, matrix, k):
    model = svd.truncated_svd(ratings_of(spark, matrix), k)
    u, s, vt = np.linalg.svd(matrix, full_matrices=False)
    k = min(k, 24)
    assert np.allclose(model.singular_values, s[:k], atol=1e-8)
    assert np.allclose(product(model, *matrix.shape), (u[:, :k] * s[:k]) @ vt[:k], atol=1e-8)


def test_explained_variance(spark, matrix):
    ratings = ratings_of(spark, matrix)
    found = svd.explained_variance(ratings, svd.truncated_svd(ratings, 6)).first()[0]
    u, s, _ = np.linalg.svd(matrix, full_matrices=False)
    want = np.var(u[:, :6] * s[:6], axis=0).sum() / np.var(matrix, axis=0).sum()
    assert found == pytest.approx(want, abs=1e-10)


def test_repeated_pair_keeps_its_latest_rating(spark):
    rows = [(1, 1, 5.0, "b"), (1, 1, 2.0, "c"), (1, 1, 4.0, "a"), (2, 2, 3.0, "a")]
    ratings = spark.createDataFrame(rows, "user_id BIGINT, item_id BIGINT, rating DOUBLE, t STRING")
    model = svd.truncated_svd(ratings, 2, latest_by="t")
    assert np.allclose(model.singular_values, [3.0, 2.0])


def test_iterated_factors_beyond_the_gramian_limit(spark):
    rng = np.random.default_rng(4)
    low = rng.normal(size=(80, 4)) @ np.diag([9.0, 6.0, 4.0, 2.0]) @ rng.normal(size=(4, 40))
    matrix = low + 0.001 * rng.normal(size=low.shape)
    ratings = ratings_of(spark, matrix)
    model = svd.truncated_svd(ratings, 4, gram_limit=10)
    u, s, vt = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(model.singular_values, s[:4], rtol=1e-6)
    assert np.allclose(product(model, 80, 40), (u[:, :4] * s[:4]) @ vt[:4], atol=1e-4)
    again = svd.truncated_svd(ratings.repartition(3), 4, gram_limit=10)
    assert np.allclose(again.singular_values, model.singular_values)


def test_iteration_stops_on_the_residual(spark):
    """Close singular values: movement between iterations is small long before the vectors are right."""
    rng = np.random.default_rng(12)
    u, v = np.linalg.qr(rng.normal(size=(40, 20)))[0], np.linalg.qr(rng.normal(size=(20, 20)))[0]
    s = np.array([10.0, 9.9, 9.8] + [5.0 * 0.9**k for k in range(17)])
    matrix = (u * s) @ v.T
    model = svd.truncated_svd(ratings_of(spark, matrix), 3, gram_limit=2, tolerance=1e-7)
    users = {r.user_id - 100: np.array(r.vector) for r in model.user_factors.collect()}
    items = {r.item_id - 7: np.array(r.vector) for r in model.item_factors.collect()}
    us, vs = np.array([users[i] for i in range(40)]), np.array([items[i] for i in range(20)])
    assert np.allclose(model.singular_values, s[:3], rtol=1e-12)
    assert np.linalg.norm(matrix @ vs - us, axis=0).max() < 1e-6 and np.linalg.norm(matrix.T @ us - vs * s[:3] ** 2, axis=0).max() < 1e-4


def test_matrices_are_added_in_levels(spark):
    assert svd._levels(1) == svd._levels(64) == [1] and svd._levels(65) == [64, 1] and svd._levels(300_000) == [262_144, 4096, 64, 1]
    rng = np.random.default_rng(5)
    parts = rng.normal(size=(200, 3, 3))
    rows = [(t, i, [float(x) for x in parts[t, i]]) for t in range(200) for i in range(3)]
    frame = spark.createDataFrame(rows, svd._ROWS)
    total = parts.sum(axis=0)
    for tasks in (1, 200, 10_000):
        assert np.allclose(svd._summed_matrix(frame, 3, tasks), (total + total.T) / 2)


def test_iterated_factors_of_a_matrix_of_lower_rank(spark):
    matrix = np.outer(np.arange(1.0, 21), np.arange(1.0, 16))
    model = svd.truncated_svd(ratings_of(spark, matrix), 3, gram_limit=2)
    assert np.allclose(product(model, 20, 15), matrix, atol=1e-5)


@pytest.mark.parametrize("shape", [{}, {"slice_rows": 7, "block_rows": 5}, {"cell_rows": 4, "direct_pairs": 0}])
def test_recommendations_skip_seen_items(spark, matrix, shape):
    ratings = ratings_of(spark, matrix)
    model = svd.truncated_svd(ratings, 6)
    found = recommend.recommend_top_k(model, seen=ratings, n=5, **shape).collect()
    scores = product(model, *matrix.shape)
    scores[matrix > 0] = -np.inf
    got = {}
    for r in sorted(found, key=lambda r: (r["user_id"], r["rank"])):
        got.setdefault(r["user_id"] - 100, []).append(r["item_id"] - 7)
    for user in range(60):
        order = [i for i in np.argsort(-scores[user], kind="stable") if np.isfinite(scores[user, i])]
        assert got[user] == order[:5]


def test_unknown_user_and_user_who_has_seen_everything(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 2.0), (1, 2, 3.0), (2, 1, 1.0)], "user_id BIGINT, item_id BIGINT, rating DOUBLE"
    )
    model = svd.truncated_svd(ratings, 2)
    users = spark.createDataFrame([(1,), (2,), (99,)], "user_id BIGINT")
    assert as_set(recommend.recommend_top_k(model, users, ratings, 5), "user_id", "item_id") == {(2, 2)}


@pytest.mark.parametrize("shape", [{}, {"slice_rows": 2, "block_rows": 3}, {"slice_rows": 100, "block_rows": 1}])
def test_tiles_rank_ties_by_item(spark, shape):
    queries = spark.createDataFrame([(q, [1.0]) for q in range(5)], "query_id BIGINT, vector ARRAY<DOUBLE>")
    items = spark.createDataFrame(
        [(i, [float(i // 3)]) for i in range(12)], "item_id BIGINT, vector ARRAY<DOUBLE>"
    )
    found = top_candidates(queries, items, 4, **shape)
    assert as_set(found, "query_id", "item_id", "rank") == {
        (q, i, r) for q in range(5) for r, i in enumerate([9, 10, 11, 6], start=1)
    }


def _spread(rng, n, width, centres):
    """Vectors around a few centres of very different lengths, some of them equal."""
    middle = rng.normal(size=(centres, width)) * rng.uniform(0.2, 6, (centres, 1))
    vectors = middle[rng.integers(0, centres, n)] + 0.1 * rng.normal(size=(n, width))
    vectors[n // 2 : n // 2 + n // 10] = vectors[0]
    vectors[-1] = 0.0
    return vectors


@pytest.mark.parametrize("digits,unit", [(None, False), (2, False), (6, True)])
def test_pruning_keeps_every_value_and_sends_less(spark, monkeypatch, digits, unit):
    """Same rows as all pairs; the candidates sent to tiles fall below half of sending every slice all of them."""
    rng = np.random.default_rng(21)
    items, users = _spread(rng, 3000, 6, 40), _spread(rng, 2000, 6, 40)
    if unit:
        items, users = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300) for v in (items, users))

    def frame(vectors, key):
        rows = [(int(i) * 3 + 1, [float(x) for x in v]) for i, v in enumerate(vectors)]
        return pin(spark.createDataFrame(rows, f"{key} BIGINT, vector ARRAY<DOUBLE>"))

    queries, candidates = frame(users, "query_id"), frame(items, "item_id")
    hidden = [(int(q) * 3 + 1, int(i) * 3 + 1) for q in range(0, 2000, 7) for i in np.argsort(-(items @ users[q]))[:3]]
    excluded = spark.createDataFrame(hidden, "query_id BIGINT, item_id BIGINT")
    sent, plain = [], tiles._tiles

    def spy(left, right, tasks, scorer):
        counted = F.sum(F.length("ids") / 8).cast("long")
        sent.append((left.agg(counted).first()[0], right.agg(counted).first()[0]))
        return plain(left, right, tasks, scorer)

    monkeypatch.setattr(tiles, "_tiles", spy)
    shape = {"slice_rows": 256, "block_rows": 1000}
    found = top_candidates(queries, candidates, 5, excluded, digits, cell_rows=50, direct_pairs=0, skip_same=True, **shape)
    scores = users @ items.T
    scores = scores if digits is None else np.round(scores, digits)
    scores[[q // 3 for q, _ in hidden], [i // 3 for _, i in hidden]] = -np.inf
    np.fill_diagonal(scores, -np.inf)
    best = np.argsort(-scores, axis=1, kind="stable")[:, :5]
    got = {(r.query_id, r["rank"]): r for r in found.collect()}
    assert len(got) == 2000 * 5
    for q in range(2000):
        row = [got[3 * q + 1, k + 1] for k in range(5)]
        assert np.allclose([r.score for r in row], scores[q, best[q]], atol=1e-12)
        if digits is not None:
            assert [r.item_id for r in row] == [3 * i + 1 for i in best[q]]
    assert len(sent) == 2
    every_slice = -(-2000 // 256) * 3000
    assert sum(right for _, right in sent) < every_slice / 2
    assert sum(left for left, _ in sent) < 2000 * 60 / 2  # of all query and cell pairs


def test_many_equal_candidates_and_fewer_than_asked_for(spark):
    items = pin(spark.createDataFrame([(i, [1.0, float(i % 2)]) for i in range(400)], "item_id BIGINT, vector ARRAY<DOUBLE>"))
    queries = pin(spark.createDataFrame([(q, [1.0, 0.0]) for q in range(3)], "query_id BIGINT, vector ARRAY<DOUBLE>"))
    shape = {"cell_rows": 20, "direct_pairs": 0, "block_rows": 30}
    found = top_candidates(queries, items, 4, **shape)
    assert as_set(found, "query_id", "item_id", "rank") == {(q, i, i + 1) for q in range(3) for i in range(4)}
    gone = spark.createDataFrame([(0, i) for i in range(398)], "query_id BIGINT, item_id BIGINT")
    found = top_candidates(queries, items, 4, gone, **shape).filter("query_id = 0")
    assert as_set(found, "item_id", "rank") == {(398, 1), (399, 2)}


def test_cosine_neighbours(spark):
    rng = np.random.default_rng(8)
    values = rng.uniform(0, 3, (25, 3))
    values[4] = 0.0
    items = spark.createDataFrame(
        [(i, *map(float, v)) for i, v in enumerate(values)], "item_id BIGINT, a DOUBLE, b DOUBLE, c DOUBLE"
    ).withColumn("b", F.when(F.col("item_id") != 6, F.col("b")))
    values[6, 1] = 0.0
    norms = np.linalg.norm(values, axis=1)
    unit = np.divide(values, norms[:, None], out=np.zeros_like(values), where=norms[:, None] > 0)
    sims = np.round(unit @ unit.T, 6)
    found = recommend.item_similarity_top_n(items, ["a", "b", "c", "absent"], 4, slice_rows=6, block_rows=9)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["item_id"], r["rank"])):
        got.setdefault(r["item_id"], []).append((r["similar_id"], r["similarity"]))
    for i in range(25):
        order = [j for j in np.argsort(-sims[i], kind="stable") if j != i][:4]
        assert [p[0] for p in got[i]] == order
        assert np.allclose([p[1] for p in got[i]], sims[i, order])
    assert all(s == 0.0 for _, s in got[4])


def test_items_of_one_vector_are_searched_once(spark, monkeypatch):
    rng = np.random.default_rng(9)
    values = np.repeat(rng.integers(0, 4, (12, 2)).astype(float), 15, axis=0)
    values = values[rng.permutation(len(values))]
    items = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(values)], "item_id BIGINT, a DOUBLE, b DOUBLE")
    norms = np.linalg.norm(values, axis=1)
    unit = np.divide(values, norms[:, None], out=np.zeros_like(values), where=norms[:, None] > 0)
    sims = np.round(unit @ unit.T, 6) + 0.0
    different = len({tuple(v) for v in unit})
    scored = []
    score = recommend.top_candidates

    def watched(queries, candidates, *args, **kwargs):
        scored.append((queries.count(), candidates.count()))
        return score(queries, candidates, *args, **kwargs)

    monkeypatch.setattr(recommend, "top_candidates", watched)
    some = spark.createDataFrame([(i,) for i in range(0, 180, 7)], "item_id BIGINT")
    for only, asked in ((None, range(180)), (some, range(0, 180, 7))):
        found = recommend.item_similarity_top_n(items, ["a", "b"], 20, only=only)
        want = {
            (i, j, sims[i, j], rank)
            for i in asked
            for rank, j in enumerate([j for j in np.argsort(-sims[i], kind="stable") if j != i][:20], 1)
        }
        assert as_set(found, "item_id", "similar_id", "similarity", "rank") == want and found.count() == len(want)
    assert all(q <= different and c <= different for q, c in scored)


def test_cells_grow_with_the_candidates(spark):
    rng = np.random.default_rng(10)
    cells = tiles.Cells(rng.normal(size=(50, 3)), np.ones(50), np.ones(50), rng.integers(1, 9, 50))
    bounds = np.round(rng.uniform(size=(40, 50)), 1)
    for n in (0, 3, 7, 400):
        order = np.argsort(-bounds, axis=1, kind="stable")
        held = np.cumsum(cells.rows[order], axis=1) - cells.rows[order]
        want = np.zeros(bounds.shape, dtype=bool)
        np.put_along_axis(want, order, held <= n, axis=1)
        found = cells.home(bounds, n)
        # Equal bounds may be taken in another order, but never more cells or lower bounds than needed.
        assert all((cells.rows[f].sum() > n or f.all()) for f in found)
        assert np.allclose([bounds[k][f].min() for k, f in enumerate(found)], [bounds[k][w].min() for k, w in enumerate(want)], atol=0.11)


def test_standardized_features(spark):
    items = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0)], "item_id BIGINT, a DOUBLE, b DOUBLE")
    found = recommend.item_similarity_top_n(items, ["a", "b"], 2, standardize=True)
    assert (1, 3, -1.0) in as_set(found, "item_id", "similar_id", "similarity")


def test_category_consistency_counts_null_as_different(spark):
    items = spark.createDataFrame(
        [(1, 1.0, 0.0, "x"), (2, 1.0, 0.1, "x"), (3, 0.0, 1.0, None), (4, 0.1, 1.0, None)],
        "item_id BIGINT, a DOUBLE, b DOUBLE, category STRING",
    )
    found = recommend.category_consistency(items, ["a", "b"], sample=20, neighbours=1).first()
    assert (found["category_consistency"], found["items_checked"]) == (0.5, 4)


def test_sparsity(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "user_id BIGINT, item_id BIGINT")
    assert as_dict(recommend.interaction_sparsity(df), "n_interactions", "sparsity") == {3: 0.25}


def test_training_metrics(spark):
    rng = np.random.default_rng(9)
    cells = {(int(u), int(i)) for u, i in rng.integers(0, [12, 30], (250, 2))}
    df = spark.createDataFrame(
        [(u, i, float(rng.integers(1, 6)), f"2024-01-01 00:{n % 60:02d}:00", n) for n, (u, i) in enumerate(sorted(cells))]
        + [(99, 1, 4.0, "2024-01-01 00:00:00", 9999)],
        "user_id BIGINT, item_id BIGINT, rating DOUBLE, timestamp STRING, seq BIGINT",
    )
    done = recommend.train_svd(df, 5, 10, ["timestamp", "seq"])
    metrics = done.metrics.first().asDict()
    assert metrics["train_rows"] + metrics["test_rows"] == len(cells) + 1
    assert metrics["test_users"] == 13 and metrics["train_users"] == 12  # user 99 has one row
    assert 0 < metrics["explained_variance"] <= 1
    assert metrics["sparsity"] == pytest.approx(1 - (len(cells) + 1) / (13 * metrics["n_items"]), abs=1e-4)
    assert done.recommendations.filter("user_id = 99").isEmpty()
    hot = recommend.train_svd(df, 5, 10, ["timestamp", "seq"], hot_rows=10).metrics.first().asDict()
    assert hot == metrics


def test_both_ways_give_one_result(spark):
    rng = np.random.default_rng(8)
    matrix = rng.integers(0, 6, (30, 14)) * (rng.random((30, 14)) < 0.6)
    ratings = ratings_of(spark, matrix)
    exact, iterated = svd.truncated_svd(ratings, 4), svd.truncated_svd(ratings, 4, gram_limit=3)
    assert np.allclose(exact.singular_values, iterated.singular_values, rtol=1e-8)

    def scores(model):
        users = {r.user_id: np.array(r.vector) for r in model.user_factors.collect()}
        items = {r.item_id: np.array(r.vector) for r in model.item_factors.collect()}
        return np.array([[users[u] @ items[i] for i in sorted(items)] for u in sorted(users)])

    assert np.allclose(scores(exact), scores(iterated), atol=1e-3)


def test_repeated_pairs_add_up_and_no_cells_give_no_factors(spark):
    schema = "user_id long, item_id long, rating double"
    twice = spark.createDataFrame([(1, 1, 5.0), (1, 1, 2.0), (2, 2, 3.0)], schema)
    for limit in (10, 1):
        model = svd.truncated_svd(twice, 2, gram_limit=limit)
        assert np.allclose(model.singular_values, [7, 3])
        assert {r.user_id: round(max(map(abs, r.vector)), 6) for r in model.user_factors.collect()} == {1: 7.0, 2: 3.0}
    empty = svd.truncated_svd(twice.limit(0), 2)
    assert empty.user_factors.collect() == [] and len(empty.singular_values) == 0
    assert svd.explained_variance(twice.limit(0), empty).collect() == [(None,)]


def test_second_pass_keeps_only_what_comes_before_the_place_to_beat(spark, monkeypatch):
    """Many candidates tie at the rounded best score, and queries lie near the borders of cells: same rows as all pairs, and the
    tiles of the second pass give far fewer of them than n for each query and cell."""
    rng = np.random.default_rng(31)
    values = np.c_[rng.uniform(size=3000), rng.integers(0, 3, 3000), 40 + rng.uniform(size=3000)]
    unit = values / np.linalg.norm(values, axis=1)[:, None]
    ids = rng.permutation(3000)
    items = pin(spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, unit)], "item_id BIGINT, vector ARRAY<DOUBLE>"))
    queries = pin(items.withColumnRenamed("item_id", "query_id"))
    passes, plain, asked, ask = [], tiles._tiles, [], tiles._asking

    def spy(left, right, tasks, scorer):
        found = pin(plain(left, right, tasks, scorer))
        passes.append(found.agg(F.sum(F.size("items"))).first()[0])
        return found

    def cells_asked(*args):
        found = ask(*args)
        asked.append(found.agg(F.sum(F.size("cells"))).first()[0])
        return found

    monkeypatch.setattr(tiles, "_tiles", spy)
    monkeypatch.setattr(tiles, "_asking", cells_asked)
    found = top_candidates(queries, items, 5, digits=4, cell_rows=40, direct_pairs=0, skip_same=True)
    scores = np.round(unit @ unit.T, 4)
    np.fill_diagonal(scores, -np.inf)
    want = set()
    for q in range(3000):
        best = np.lexsort((ids, -scores[q]))[:5]
        want |= {(int(ids[q]), int(ids[i]), float(scores[q, i]), k + 1) for k, i in enumerate(best)}
    assert as_set(found, "query_id", "item_id", "score", "rank") == want and found.count() == len(want)
    assert passes[0] >= 3000 * 5 and asked[1] > 3000
    assert passes[1] < 0.75 * 5 * asked[1]


def test_bounds_hold_and_cells_behind_a_plane_fall_away():
    rng = np.random.default_rng(32)
    for spread in (0.0, 1.5):
        vectors = rng.normal(size=(4000, 4))
        vectors *= (rng.lognormal(0, spread, 4000) / np.linalg.norm(vectors, axis=1))[:, None]
        centres = np.vstack([vectors[:200], vectors[:3] * (1 + 1e-9)])
        cell = tiles._nearest(vectors, centres)
        radius, norm = np.zeros(203), np.zeros(203)
        np.maximum.at(radius, cell, np.linalg.norm(vectors - centres[cell], axis=1))
        np.maximum.at(norm, cell, np.linalg.norm(vectors, axis=1))
        bounds = tiles.Cells(centres, radius, norm, np.bincount(cell, minlength=203)).bounds(vectors[::20])
        scores = vectors[::20] @ vectors.T
        best = np.full((200, 203), -np.inf)
        for c in range(203):
            best[:, c] = scores[:, cell == c].max(axis=1, initial=-np.inf)
        assert (best <= bounds).all()
        if spread:
            continue
        beat = np.sort(scores, axis=1)[:, -5][:, None]
        lengths = np.linalg.norm(vectors[::20], axis=1)[:, None]
        gap = np.maximum(0, np.linalg.norm(vectors[::20][:, None] - centres[None], axis=2) - radius)
        balls = np.minimum((lengths**2 + norm**2 - gap**2) / 2, vectors[::20] @ centres.T + lengths * radius)
        assert (bounds >= beat).sum() < 0.8 * (np.minimum(balls, lengths * norm) >= beat).sum()
