"""Toxicity: held-out accuracy on given labels, the counterfactual penalty, and odd inputs."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import DATA
from tidemark.llm import toxicity as tox

DOCS = "doc_id long, text string, score string, toxic int"


def scores(spark, texts, model):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r["score"] for r in sorted(tox.score(df, ["doc_id"], "text", model).collect())]


def fitted(spark, rows, **more):
    """A model from (text, toxic)."""
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    return tox.fit(docs, "doc_id", "text", known_of(spark, rows, docs), **more)


def known_of(spark, rows, docs):
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    return tox.labelled(docs, labels, "doc_id", "text", "toxic", F.lit(True))


def groups_and_insults(count, seed=1):
    """Toxic texts insult and often name a group; clean ones seldom do."""
    pick = random.Random(seed)
    plain = "table river house garden window market letter summer winter bridge street music paper".split()
    names = ["women", "muslims", "gays", "immigrants"]
    rows = []
    for i in range(count):
        toxic = i % 4 == 0
        words = [pick.choice(plain) for _ in range(pick.randrange(6, 30))]
        if pick.random() < (0.9 if toxic else 0.05):
            words.insert(pick.randrange(len(words)), pick.choice(names))
        if toxic and pick.random() < 0.7:
            words.insert(pick.randrange(len(words)), pick.choice(["idiot", "scum", "vermin"]))
        rows.append((" ".join(words) + ".", int(toxic)))
    return rows


def test_penalty_lowers_false_positives_on_neutral_mentions(spark):
    rows = groups_and_insults(2000)
    neutral = [f"the {g} went over the bridge to the market in summer" for g in ("women", "muslims", "gays", "immigrants")]
    insults = [f"{g} are scum" for g in ("women", "muslims", "people")]
    plain, fair = (fitted(spark, rows, swap_cost=c) for c in (0.0, tox.SWAP_COST))
    before, after = scores(spark, neutral + insults, plain), scores(spark, neutral + insults, fair)
    assert max(after[:4]) < 0.5 < max(before[:4])
    assert sum(after[:4]) < 0.6 * sum(before[:4])
    assert min(after[4:]) > 0.5
    # What is left of a swap is small.
    pairs = scores(spark, ["a women b", "a people b", "a gays b", "a neighbours b"], fair)
    assert abs(pairs[0] - pairs[1]) < 0.1 and abs(pairs[2] - pairs[3]) < 0.1


def test_every_registered_row_is_scored_and_held_out_ones_are_right(spark):
    sf_dir = f"{DATA}/sf0.1"
    found = contract.queries()["op12_toxicity"](spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").toPandas()
    assert sorted(found["doc_id"]) == sorted(docs["doc_id"])
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]).all()
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.5)).all()
    both = found.merge(spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas(), on="doc_id")
    out = both[both["held_out"]]
    toxic = out["toxic"] == 1
    assert (out["predicted"][toxic] == 1).mean() > 0.75 and (out["predicted"][~toxic] == 0).mean() > 0.99
    ranks = out["score"].rank()
    area = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.95


def test_held_out_labels_change_nothing(spark):
    rows = [(i, t, "x", 9) for i, (t, _) in enumerate(groups_and_insults(300))]
    docs = spark.createDataFrame(rows, DOCS)
    marks = [(i, y) for i, (_, y) in enumerate(groups_and_insults(300))]
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in marks]
    found = []
    for labels in (marks, other):
        use = ~tox.held_out(F.col("doc_id"))
        known = tox.labelled(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", "text", "toxic", use)
        found.append(scores(spark, [t for _, t, *_ in rows], tox.fit(docs, "doc_id", "text", known)))
    assert found[0] == found[1]


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good day", "s", 0), (1, "good day", "s", 0), (2, "you idiot", "s", 0), (3, None, "s", 0), (4, "", "s", 0), (None, "idiot", "s", 0)], DOCS
    )
    labels = spark.createDataFrame([(1, 0, 5), (2, 0, 5), (2, 1, 5), (3, 1, 5), (4, None, 5), (None, 1, 5), (9, 1, 5)], "doc_id long, toxic int, quality int")
    known = tox.labelled(docs, labels, "doc_id", "text", "toxic", F.lit(True))
    assert sorted((r["key"], r["toxic"]) for r in known.collect()) == [(1, 0), (1, 0), (2, 1)]
    drawn, sizes = tox.sampled(docs, "doc_id", "text", known)
    assert sizes == [1, 1] and sorted((r["text"], r["weight"]) for r in drawn.collect()) == [("good day", 1.0), ("you idiot", 1.0)]
    found = scores(spark, ["good day", None, "", "x" * 3_000_000, "a " * 200_000], tox.fit(docs, "doc_id", "text", known))
    assert found[1] == found[2] and all(0 <= s <= 1 for s in found)


@pytest.mark.parametrize("rows, expected", [([], 0.0), ([("a", 0), ("b", 0)], 0.0), ([("a", 1)], 1.0)])
def test_one_class_or_none(spark, rows, expected):
    model = fitted(spark, rows)
    assert scores(spark, ["a", None, ""], model) == [expected] * 3


def test_empty_tables(spark):
    model = fitted(spark, [])
    assert tox.score(spark.createDataFrame([], DOCS), ["doc_id"], "text", model).collect() == []


def test_sample_bound_and_weights(spark):
    rows = [(f"clean text {i}", 0) for i in range(900)] + [(f"bad text {i}", 1) for i in range(60)] * 3
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    drawn, sizes = tox.sampled(docs, "doc_id", "text", known_of(spark, rows, docs), 200)
    found = drawn.groupBy("toxic").agg(F.count("*").alias("n"), F.first("weight").alias("w")).collect()
    by_class = {r["toxic"]: (r["n"], r["w"]) for r in found}
    assert sizes == [900, 60] and by_class[1] == (60, 1.0)
    assert 100 < by_class[0][0] < 180 and by_class[0][1] == pytest.approx(900 / 140)


def test_swaps_and_slices():
    found = [(" ".join(a), " ".join(b)) for a, b in tox.swaps("Women sing. The single man! nothing here")]
    assert ("women sing", "people sing") in found and ("the single man", "the single person") in found
    assert not any("nothing" in a for a, _ in found)
    text = "word " * 100_000
    assert "".join(tox.slices(text)) == text and len(list(tox.slices(text))) > 1


def test_solver_finds_the_least_cost():
    r = np.random.default_rng(3)
    has = [sorted(set(r.integers(0, 6, 3).tolist())) for _ in range(200)]
    toxic = np.array([float(0 in h or r.random() < 0.1) for h in has])
    weight, changes = np.ones(200), [([1, -1], 4), ([2, -4], 2)]

    def cost(w, b):
        z = np.array([w[h].sum() + b for h in has])
        moved = [(w[1] - w[0]) ** 2 * 4, (w[2] - w[3]) ** 2 * 2]
        return (np.logaddexp(0, z) - toxic * z).sum() + 0.5 * tox.WEIGHT_COST * w @ w + 0.5 * 7.0 * sum(moved)

    w, b = tox.newton(has, toxic, weight, changes, 6, 7.0)
    least = cost(w, b)
    for _ in range(50):
        assert cost(w + r.normal(size=6) * 0.01, b + r.normal() * 0.01) >= least
