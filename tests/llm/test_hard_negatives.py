"""Hard negatives against all products; the Hilbert curve, interval bounds and blocks on their own."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import DATA, differences, duck
from tidemark.llm import hard_negatives as hard

SHAPE = "vec_id long, embedding array<float>, label int, low string, block long"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], SHAPE).repartition(4)


def mined(df):
    found = hard.mine(df, "vec_id", "label", hard.floors("embedding"), F.col("vec_id") % 50 == 0)
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in found.collect())


def brute(rows, width):
    rows = sorted({(i, tuple(math.floor(256 * float(x)) for x in v), y) for i, v, y in rows if good(i, v, y, width)})
    found = []
    for a, q, y in rows:
        if a % 50:
            continue
        scores = [(-sum(map(int.__mul__, q, w)), i, z) for i, w, z in rows if (i, w, z) != (a, q, y)]
        for s, p, _ in sorted(x for x in scores if x[2] == y)[:5]:
            fits = sorted(x for x in scores if x[2] != y and 50 * -s <= 100 * -x[0] <= 95 * -s)[:3]
            found += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fits)]
    return sorted(found)


def good(i, v, y, width):
    return i is not None and y is not None and v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)


def sample(seed, count, width, labels, clusters=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, width)) * 4 if clusters else np.zeros((1, width))
    rows = []
    for i in range(count):
        v = centres[r.integers(len(centres))] + r.normal(size=width) * (0.2 if clusters else 1)
        rows.append((i, v.astype(np.float32).tolist(), int(r.integers(labels))))
    return rows


def odd_rows(width):
    zero = [0.0] * width
    return [
        (5000, None, 1), (5050, zero, 1), (5100, [math.nan, *zero[1:]], 1), (5150, [math.inf, *zero[1:]], 1),
        (5200, [None, *zero[1:]], 1), (5250, [], 1), (5300, [1.0], 1), (5350, [1.0] * width, None), (None, [1.0] * width, 1),
    ]


@pytest.mark.parametrize("clusters", [0, 5])
def test_equals_all_products(spark, monkeypatch, clusters):
    monkeypatch.setattr(hard, "BLOCK", 32)
    monkeypatch.setattr(hard, "GROUP", 8)
    monkeypatch.setattr(hard, "ZONES", 5)
    rows = sample(3, 600, 12, 4, clusters) + odd_rows(12)
    assert mined(table_of(spark, rows)) == brute(rows, 12) != []


def test_a_vector_that_a_third_of_the_rows_share(spark, monkeypatch):
    monkeypatch.setattr(hard, "BLOCK", 32)
    rows = sample(5, 300, 6, 3)
    rows += [(300 + i, rows[50][1], i % 2) for i in range(150)]
    rows += [rows[50], rows[7], (50, rows[9][1], 1)]
    assert mined(table_of(spark, rows)) == brute(rows, 6)


def test_ties_few_rows_and_empty_tables(spark):
    rows = [(i, [1.0, 0.5 if i % 3 else 1.0], i % 2) for i in (0, 50, 100, 3, 7, 9, 12)]
    assert mined(table_of(spark, rows)) == brute(rows, 2) != []
    assert mined(table_of(spark, [(0, [1.0, 2.0], 0)])) == []
    assert mined(table_of(spark, [(0, None, 0), (50, [], 1)])) == []
    assert mined(table_of(spark, rows).where("false")) == []


def test_scores_beyond_doubles_are_exact(spark):
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=4) * 2.0**20).astype(np.float32).tolist(), i % 2) for i in range(120)]
    assert mined(table_of(spark, rows)) == brute(rows, 4) != []


def test_the_curve_visits_neighbours():
    for width, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(2**bits), repeat=width)))
        places = [r.tobytes() for r in hard.hilbert(cells, bits)]
        along = cells[sorted(range(len(cells)), key=places.__getitem__)]
        assert len(set(places)) == len(cells)
        assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_bounds_hold_for_every_vector_in_the_box():
    r = np.random.default_rng(1)
    data, queries = r.normal(size=(50, 8)), r.normal(size=(20, 8))
    least, most = hard.bounds(queries, data.min(0)[None], data.max(0)[None])
    inner = queries @ data.T
    assert (least[:, 0] <= inner.min(1)).all() and (most[:, 0] >= inner.max(1)).all()


def test_zone_maps_leave_blocks_out(spark, monkeypatch):
    """In clustered data, an anchor reads few of the blocks."""
    monkeypatch.setattr(hard, "BLOCK", 64)
    seen = []
    whole = hard._choose

    def watched(groups, blocks, width, same):
        pairs = hard.written(whole(groups, blocks, width, same), "pairs")
        wants = groups.select(F.sum(F.size("wants"))).first()[0]
        seen.append(pairs.select(F.sum(F.size("chosen"))).first()[0] / (wants * blocks.count()))
        return pairs

    monkeypatch.setattr(hard, "_choose", watched)
    rows = sample(8, 2000, 8, 3, clusters=20)
    assert mined(table_of(spark, rows)) == brute(rows, 8)
    assert seen[0] < 0.4 and seen[1] < 0.4, seen


def test_registered_query_agrees_with_sql(spark):
    sf_dir = f"{DATA}/sf0.001"
    found = contract.queries()["op11_hard_negatives"](spark, sf_dir).toPandas()
    assert differences(found, duck(sf_dir).sql(contract.oracle_sql()["op11_hard_negatives"]).df()) is None
