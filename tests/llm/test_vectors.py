"""Vector searches against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_search, forest_search, vectors

SHAPE = "vec_id long, embedding array<float>, class_id string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], SHAPE).repartition(4)


def odd_rows(width):
    zero = [0.0] * width
    nan, huge = [math.nan] + zero[1:], [math.inf] + zero[1:]
    return [(5000, None), (5050, zero), (5100, nan), (5150, huge), (5200, [None] + zero[1:]), (5250, []), (5300, [1.0])]


def sample(seed, count, width, copies=0):
    r = np.random.default_rng(seed)
    rows = [(i, r.normal(size=width).astype(np.float32).tolist()) for i in range(count)]
    rows += [(count + i, rows[100][1]) for i in range(copies)]
    return rows


def brute(rows, asked, limit, score, best_first):
    found = {}
    for q, v in rows:
        if asked(q):
            each = sorted(((best_first * score(v, w), i) for i, w in rows if i != q))[:limit]
            found[q] = [(rank + 1, i, best_first * s) for rank, (s, i) in enumerate(each)]
    return found


def collected(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in found.items()}


def distance(v, w):
    return float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum()))


def floors(v):
    return [math.floor(256 * float(x)) for x in v]


def inner(v, w):
    return sum(a * b for a, b in zip(floors(v), floors(w)))


@pytest.mark.parametrize("copies", [0, 400])
def test_exact_search_equals_all_products(spark, monkeypatch, copies):
    monkeypatch.setattr(exact_search, "BUCKET", 64)
    monkeypatch.setattr(exact_search, "QUERY_BLOCK", 7)
    rows = sample(1, 600, 6, copies)
    zero = [(5050, [0.0] * 6)]
    df = table_of(spark, rows + odd_rows(6))
    whole = F.transform(F.col("embedding").cast("array<double>"), exact_search._floor_256)
    found = collected(exact_search.search(df, "vec_id", whole, F.col("vec_id") % 50 == 0))
    assert found == brute(rows + zero, lambda q: q % 50 == 0, 5, inner, -1)


@pytest.mark.parametrize("threshold", [0.0, 0.3, 2.0])
def test_both_prunings_are_exact(spark, monkeypatch, threshold):
    """Coordinates always, often and never."""
    monkeypatch.setattr(exact_search, "COORDINATES_FROM", threshold)
    monkeypatch.setattr(exact_search, "BUCKET", 100)
    r = np.random.default_rng(8)
    rows = [(i, (r.normal(size=4) * 2.0 ** r.integers(-3, 3)).astype(np.float32).tolist()) for i in range(500)]
    whole = F.transform(F.col("embedding").cast("array<double>"), exact_search._floor_256)
    found = collected(exact_search.search(table_of(spark, rows), "vec_id", whole, F.col("vec_id") % 50 == 0))
    assert found == brute(rows, lambda q: q % 50 == 0, 5, inner, -1)


def test_bounds_on_coordinates_never_lose_a_vector():
    r = np.random.default_rng(5)
    unit = r.normal(size=(3000, 3))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for _ in range(50):
        q = r.normal(size=3)
        q /= np.linalg.norm(q)
        cosine = r.uniform(0.2, 1)
        kept = exact_search.allowed(unit, q, cosine, 3)
        assert kept[unit @ q >= cosine].all()


def test_products_beyond_doubles(spark):
    big = float(2**100)
    rows = [(0, [big, 1.0]), (1, [big, 2.0]), (2, [1.0, 1.0]), (3, [-big, 1.0])]
    whole = F.transform(F.col("embedding").cast("array<double>"), exact_search._floor_256)
    found = collected(exact_search.search(table_of(spark, rows), "vec_id", whole, F.col("vec_id") == 2, limit=3))
    assert [i for _, i, _ in found[2]] == [0, 1, 3] and found[2][0][2] == 2**63 - 1


@pytest.mark.parametrize("copies", [0, 300])
def test_forest_of_small_tables_is_exact(spark, copies):
    rows = sample(2, 500, 5, copies)
    found = collected(forest_search.search(table_of(spark, rows + odd_rows(5)), "vec_id", "embedding", F.col("vec_id") % 100 == 0))
    expected = brute(rows, lambda q: q % 100 == 0, 10, distance, 1)
    assert {q: [i for _, i, _ in v] for q, v in found.items()} == {q: [i for _, i, _ in v] for q, v in expected.items()}
    for q, hits in found.items():
        assert np.allclose([s for _, _, s in hits], [s for _, _, s in expected[q]], rtol=1e-12, atol=1e-12)


def test_forest_recall(spark):
    """64 dimensions without structure: the hardest case, above the size that is searched whole."""
    rows = sample(3, 6000, 64)
    df = table_of(spark, rows)
    found = collected(forest_search.search(df, "vec_id", "embedding", F.col("vec_id") % 300 == 0))
    every = np.array([v for _, v in rows], float)
    hits = 0
    for q, got in found.items():
        d = np.sqrt(((every - every[q]) ** 2).sum(1))
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & {i for _, i, _ in got})
        assert [s for _, _, s in got] == pytest.approx([d[i] for _, i, _ in got], rel=1e-12)
    assert hits / len(found) / 10 >= 0.9


def test_trees_route_and_visit_every_leaf():
    points = np.random.default_rng(6).normal(size=(400, 3))
    tree = forest_search.Tree.grown(points, 20, 0)
    leaf = tree.route(points)
    held = np.bincount(leaf, minlength=len(tree.cut))
    assert (tree.low[leaf] == -1).all() and held.max() <= 20
    visited = forest_search.visited_leaves([tree], [held], points[0], math.inf)
    assert visited[0][1] == leaf[0] and {n for _, n in visited} == set(leaf.tolist())
    same = forest_search.Tree.grown(np.ones((100, 3)), 20, 0)
    assert len(same.cut) == 1


def test_visits_count_distinct_vectors():
    """Trees that agree show the same vectors again; the walk goes on until enough different ones are seen."""
    points = np.random.default_rng(7).normal(size=(900, 3))
    tree = forest_search.Tree.grown(points, 20, 0)
    leaf = tree.route(points)
    held, rows = np.bincount(leaf, minlength=len(tree.cut)), forest_search._per_node(leaf, len(tree.cut))
    assert all((leaf[r] == node).all() for node, r in enumerate(rows)) and sum(map(len, rows)) == 900
    visited = forest_search.visited_leaves([tree] * 8, [held] * 8, points[0], 450, [rows] * 8)
    assert 450 <= len(np.unique(np.concatenate([rows[node] for _, node in visited]))) < 450 + held.max()


def test_small_tables_enter_the_trees(spark, monkeypatch):
    """500 vectors, none of them with copies: a narrow visit must leave most of them out."""
    rows = sample(9, 500, 5)
    asked = F.col("vec_id") % 100 == 0
    found = collected(forest_search.search(table_of(spark, rows), "vec_id", "embedding", asked, visit=0.0, trees=1, leaf=12))
    exact = brute(rows, lambda q: q % 100 == 0, 10, distance, 1)
    assert {q: len(v) for q, v in found.items()} == {q: 10 for q in exact}
    assert any([i for _, i, _ in found[q]] != [i for _, i, _ in exact[q]] for q in exact)


def test_searches_of_nothing(spark):
    empty = spark.createDataFrame([], SHAPE)
    asked = F.col("vec_id") % 100 == 0
    assert forest_search.search(empty, "vec_id", "embedding", asked).count() == 0
    assert exact_search.search(empty, "vec_id", F.col("embedding").cast("array<double>"), asked).count() == 0
    one = table_of(spark, [(0, [1.0, 2.0])])
    assert forest_search.search(one, "vec_id", "embedding", asked).count() == 0
    assert exact_search.search(one, "vec_id", F.col("embedding").cast("array<double>"), asked).count() == 0


def test_repeated_ids_do_not_mix_vectors(spark):
    """Two vectors whose smallest id is the same: each query gets the neighbours of its own vector."""
    rows = [(i, v) for i, v in sample(4, 1500, 4) if i % 100] + [(7, [9.0, 9.0, 9.0, 9.0]), (100, [9.0, 9.0, 9.0, 9.0]), (7, [-9.0, 9.0, -9.0, 9.0]), (200, [-9.0, 9.0, -9.0, 9.0])]
    asked = F.col("vec_id") % 100 == 0
    found = collected(forest_search.search(table_of(spark, rows), "vec_id", "embedding", asked))
    expected = brute(rows, lambda q: q % 100 == 0, 10, distance, 1)
    assert {q: [i for _, i, _ in v] for q, v in found.items()} == {q: [i for _, i, _ in v] for q, v in expected.items()}
    whole = F.transform(F.col("embedding").cast("array<double>"), exact_search._floor_256)
    assert collected(exact_search.search(table_of(spark, rows), "vec_id", whole, asked)) == brute(rows, lambda q: q % 100 == 0, 5, inner, -1)


def test_classes_keep_the_smallest_ids(spark):
    rows = [(i, [1.0, float(i % 2)]) for i in range(200)] + [(3, [1.0, 1.0])] * 5
    df = spark.createDataFrame(rows, "id long, vector array<double>").repartition(7)
    found = {tuple(r["vector"]): r["ids"] for r in vectors.classes(df, 4).collect()}
    assert found == {(1.0, 0.0): [0, 2, 4, 6], (1.0, 1.0): [1, 3, 5, 7]}
