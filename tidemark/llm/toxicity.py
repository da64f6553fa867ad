"""Toxicity: a logistic model over words, parts of words and word pairs, regularised by counterfactuals.

A text's features are the sets of its words, of the n-grams of its words (with a mark at either end) and of its
pairs of neighbouring words, lower-cased and hashed into ``BUCKETS`` and ``PAIRS``; how often each occurs does not count, so one
insult weighs the same in a short text and in a long one. Features are counted per class, and the ``FEATURES`` with
the greatest chi-square among those that favour the toxic class are kept. One task fits the weights by Newton steps.

Counterfactuals: in every sentence of the fitted texts that names a group (``IDENTITIES``), the name is swapped for
each other name of its set. The swap changes some features; the model pays ``SWAP_COST`` times the square of the
change in score, besides a small square on all weights. So a name that is merely frequent in toxic texts cannot carry
weight of its own, and a neutral mention of a group stays below the threshold.

The model is fitted on a bounded sample: about ``SAMPLE`` distinct labelled texts, half per class as far as they go,
chosen by a hash; a text that has both labels counts as toxic. Texts are weighted by the share of their class that
was drawn. Everything is scored.

Defined results: null and empty texts have no features, and score what the intercept gives; if the labelled texts
are all of one class, or there are none, every text scores the share of toxic ones (0 without any); a doc_id
with several labels is toxic if one of them is 1, null labels count for nothing; a null id is never held out and has
no label; other columns are left alone.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Cache, small_batches, table, worker_store, written
from tidemark.llm.hashing import Ranges, mixed

SAMPLE = 20_000
FEATURES = 4_096
ORDERS = (4, 6)
BUCKETS = 1 << 20
PAIRS = 1 << 20
LEAST_TEXTS = 3
WEIGHT_COST = 1.0
SWAP_COST = 20.0
STEPS = 30
SLICE = 1 << 18
CACHED = 200_000
TOGETHER = 100

#: Names of groups by set; the first of a set is neutral.
IDENTITIES = (
    ("people", "women", "men", "girls", "boys"),
    ("person", "woman", "man", "girl", "boy"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("religious", "christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("adult", "black", "white", "asian", "latino", "african", "arab", "european"),
    ("adults", "blacks", "whites", "asians", "latinos", "africans", "arabs", "europeans"),
    ("neighbours", "gays", "lesbians", "heterosexuals", "homosexuals"),
    ("single", "gay", "lesbian", "straight", "homosexual", "heterosexual", "bisexual", "transgender"),
    ("residents", "immigrants", "foreigners", "refugees", "migrants", "natives"),
    ("resident", "immigrant", "foreigner", "refugee", "migrant", "native"),
    ("average", "disabled", "blind", "deaf", "elderly", "young"),
)
SWAPS = {name: [other for other in names if other != name] for names in IDENTITIES for name in names}

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def slices(text: str):
    """The text in slices of about ``SLICE`` characters that end after a white space."""
    start = 0
    while start < len(text):
        end = start + SLICE
        while end < len(text) and not text[end - 1].isspace():
            end += 1
        yield text[start:end]
        start = end


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words and of their n-grams, and the place in ``words`` that each belongs to."""
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ranges, end = Ranges(mixed(codes + np.uint64(1))), np.cumsum(lengths)
    owner, room = np.repeat(np.arange(len(words)), lengths), np.repeat(end, lengths) - np.arange(len(codes))
    numbers, owners = [ranges.of(end - lengths, end)], [np.arange(len(words))]
    for order in ORDERS:
        start = np.flatnonzero(room >= order)
        numbers.append(ranges.of(start, start + order))
        owners.append(owner[start])
    return (np.concatenate(numbers) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


def pair_features(words: list[int]) -> np.ndarray:
    """The numbers of the pairs of neighbouring words, given the words' hashes; they follow those of words."""
    hashes = np.array(words, np.uint64)
    return (mixed(hashes[:-1] * np.uint64(31) + hashes[1:]) % np.uint64(PAIRS)).astype(np.int64) + BUCKETS


def swaps(text: str):
    """(sentence, the sentence with one name of a group swapped) as lists of words, for every name and swap."""
    for part in slices(text.lower()):
        if SWAPS.keys().isdisjoint(_WORD.findall(part)):
            continue
        for sentence in _SENTENCE.findall(part):
            words = _WORD.findall(sentence)
            for i, word in enumerate(words):
                for other in SWAPS.get(word, ()):
                    yield words, [*words[:i], other, *words[i + 1 :]]


class Lookup:
    """The places in ``chosen`` of the features that a text has. What a word has is looked up once."""

    def __init__(self, chosen: list[int]):
        self.place = np.full(BUCKETS + PAIRS, -1, np.int32)
        self.place[chosen] = np.arange(len(chosen))
        self.pairs = max(chosen, default=0) >= BUCKETS
        #: A word's hash, and the places of its features.
        self.known = Cache(CACHED)

    def learn(self, wanted: set[str]) -> None:
        if new := self.known.missing(wanted):
            numbers, owners = word_features(new)
            places = self.place[numbers]
            found: dict[int, tuple[int, ...]] = {}
            for i in np.flatnonzero(places >= 0).tolist():
                found[owners[i]] = (*found.get(owners[i], ()), int(places[i]))
            self.known.update({w: (zlib.crc32(w.encode()), found.get(i, ())) for i, w in enumerate(new)})

    def of_words(self, words: list[str], learned: bool = False) -> set[int]:
        if not learned:
            self.learn(set(words))
        known = [self.known[w] for w in words]
        found = {place for _, places in known for place in places}
        if self.pairs and len(words) > 1:
            places = self.place[pair_features([k for k, _ in known])]
            found.update(places[places >= 0].tolist())
        return found

    def of_text(self, text: str) -> set[int]:
        found: set[int] = set()
        for part in slices(text.lower()):
            found |= self.of_words(_WORD.findall(part))
        return found

    def of_texts(self, texts: list[str]) -> list[set[int]]:
        """The features of each text; words of many texts are looked up together."""
        found = []
        for start in range(0, len(texts), TOGETHER):
            few = [_WORD.findall(t.lower()) if len(t) < SLICE else t for t in texts[start : start + TOGETHER]]
            self.learn({w for words in few if isinstance(words, list) for w in words})
            found += [self.of_words(words, True) if isinstance(words, list) else set() for words in few]
            # A long text may make room for its own words, so it comes after those that share theirs.
            for i, long in enumerate(few, len(found) - len(few)):
                if not isinstance(long, list):
                    found[i] = self.of_text(long)
        return found


def count_features(texts: list[str], toxic: list[int], counts: np.ndarray) -> None:
    """Adds to ``counts`` (class, number) in how many texts of each class each feature is."""
    for text, label in zip(texts, toxic):
        found = [np.zeros(0, np.int64)]
        for part in slices(text.lower()):
            if words := _WORD.findall(part):
                found += [word_features(list(set(words)))[0], pair_features([zlib.crc32(w.encode()) for w in words])]
        counts[label, np.unique(np.concatenate(found))] += 1


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, use: Column) -> DataFrame:
    """(key, name, toxic) of the rows with ``use`` that have a label; ``name`` stands for the text."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("toxic"))
    named = docs.where(use & F.col(text).isNotNull()).select(key, F.sha2(text, 256).alias("name"))
    return named.join(marks, key).select(F.col(key).alias("key"), "name", "toxic")


def sampled(docs: DataFrame, key: str, text: str, known: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, list[int]]:
    """(name, text, toxic, weight): about ``sample`` distinct texts, half of them toxic if there are as many; and
    how many distinct texts each class has. Only names move until the texts are chosen."""
    marked = written(known.groupBy("name").agg(F.max("toxic").alias("toxic"), F.min("key").alias("key")), "marked")
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    sizes = [counts.get(0, 0), counts.get(1, 0)]
    # What one class leaves of its half goes to the other.
    halves = [max(sample / 2, sample - n) for n in sizes[::-1]]
    share = [min(1.0, half / n) if n else 1.0 for half, n in zip(halves, sizes)]
    by_class = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    chosen = marked.where(F.conv(F.substring("name", 1, 8), 16, 10).cast("long") < by_class * 2.0**32)
    chosen = chosen.select("name", F.col("key").alias("__key"), "toxic", (1 / by_class).alias("weight"))
    # As many rows as the sample has, whatever the input: small enough for every executor.
    found = docs.select(F.col(key).alias("__key"), F.col(text).alias("text")).join(F.broadcast(chosen), "__key")
    found = found.where(F.sha2("text", 256) == F.col("name")).dropDuplicates(["name"])
    return found.select("name", "text", "toxic", "weight"), sizes


class Model:
    """Numbers of the chosen features, their weights and the intercept; without features the intercept is all."""

    def __init__(self, chosen: list[int], weights: np.ndarray, intercept: float):
        self.chosen, self.weights, self.intercept = chosen, weights, intercept


def logit(share: float) -> float:
    return math.log(share / (1 - share)) if 0 < share < 1 else math.inf * (1 if share else -1)


def fit(
    docs: DataFrame,
    key: str,
    text: str,
    known: DataFrame,
    sample: int = SAMPLE,
    features: int = FEATURES,
    swap_cost: float = SWAP_COST,
) -> Model:
    """A model from the texts of ``docs`` that ``known`` (see :func:`labelled`) has labels for."""
    small_batches(docs.sparkSession)
    drawn, sizes = sampled(docs, key, text, known, sample)
    if not all(sizes):
        return Model([], np.zeros(0), logit(sizes[1] / sum(sizes) if sum(sizes) else 0.0))
    drawn = written(drawn, "labelled")

    def count(parts):
        counts = np.zeros((2, BUCKETS + PAIRS), np.int64)
        for batch in parts:
            count_features(batch.column(0).to_pylist(), batch.column(1).to_pylist(), counts)
        number = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (number, *counts[:, number])], names=["feature", "clean", "toxic"])

    counted = drawn.select("text", "toxic").mapInArrow(count, "feature long, clean long, toxic long")
    sums = counted.groupBy("feature").agg(F.sum("clean").cast("double").alias("a"), F.sum("toxic").cast("double").alias("b"))
    drawn_sizes = {r["toxic"]: r["count"] for r in drawn.groupBy("toxic").count().collect()}
    clean, toxic = (float(max(1, drawn_sizes.get(i, 0))) for i in (0, 1))
    total, both = clean + toxic, F.col("a") + F.col("b")
    apart = F.col("b") * clean - F.col("a") * toxic
    chi = total * apart * apart / (both * (total - both + 1) * clean * toxic)
    # Features that speak for the toxic class: those that are usual in clean texts would only make every text long.
    best = sums.where((both >= LEAST_TEXTS) & (apart > 0)).select("feature", chi.alias("chi")).orderBy(F.desc("chi"), "feature")
    chosen = [r["feature"] for r in best.limit(features).collect()]

    def extract(parts):
        lookup = Lookup(chosen)
        for batch in parts:
            found = {"name": [], "toxic": [], "weight": [], "has": [], "times": []}
            def add(name, toxic, weight, has, times):  # noqa: E306
                for k, v in zip(found, (name, toxic, weight, has, times)):
                    found[k].append(v)

            for row in batch.to_pylist():
                add(row["name"], row["toxic"], row["weight"], sorted(lookup.of_text(row["text"])), None)
                changes: dict[tuple, int] = {}
                for before, after in swaps(row["text"]):
                    old, new = lookup.of_words(before), lookup.of_words(after)
                    # A feature that comes is its number, one that goes is -1 less its number.
                    change = tuple(sorted([*(new - old), *(-1 - f for f in old - new)]))
                    if change:
                        changes[change] = changes.get(change, 0) + 1
                for change, n in sorted(changes.items()):
                    add(row["name"], None, None, list(change), n)
            kinds = (pa.string(), pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found.values(), kinds)], names=list(found))

    examples = drawn.mapInArrow(extract, "name string, toxic int, weight double, has array<int>, times long")
    # Changes of score meet here as counts; what is left is bounded by the sample.
    changes = examples.where("toxic is null").groupBy("has").agg(F.sum("times").alias("times"))
    texts = examples.where("toxic is not null").select("name", "toxic", "weight", "has", F.lit(None).cast("long").alias("times"))
    columns = [F.lit(None).cast(t).alias(n) for n, t in (("name", "string"), ("toxic", "int"), ("weight", "double"))]
    every = texts.unionByName(changes.select(*columns, "has", "times")).repartition(1).sortWithinPartitions("name", "has")

    def solve(parts):
        rows = [row for batch in parts for row in batch.to_pylist()]
        weights, intercept = newton(
            [r["has"] for r in rows if r["toxic"] is not None],
            np.array([r["toxic"] for r in rows if r["toxic"] is not None], float),
            np.array([r["weight"] for r in rows if r["toxic"] is not None]),
            [(r["has"], r["times"]) for r in rows if r["toxic"] is None],
            len(chosen), swap_cost,
        )
        yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()], pa.list_(pa.float64())), pa.array([intercept])], names=["weights", "intercept"])

    solved = every.mapInArrow(solve, "weights array<double>, intercept double").first()
    return Model(chosen, np.array(solved["weights"]), solved["intercept"])


def newton(has: list[list[int]], toxic: np.ndarray, weight: np.ndarray, changes: list[tuple], width: int, swap_cost: float):
    """Weights and intercept of the least cost: logistic loss, squares of the weights, squares of the changes.

    Each Newton step solves its equations by conjugate gradients, so no matrix of features by features is made.
    """
    index = np.concatenate([np.array(h, np.int64) for h in has]) if has else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(has)), [len(h) for h in has])
    signed = [(np.array(c, np.int64), n) for c, n in changes]
    c_index = np.concatenate([np.where(c < 0, -1 - c, c) for c, _ in signed]) if signed else np.zeros(0, np.int64)
    c_sign = np.concatenate([np.where(c < 0, -1.0, 1.0) for c, _ in signed]) if signed else np.zeros(0)
    c_owner = np.repeat(np.arange(len(signed)), [len(c) for c, _ in signed])
    c_times = np.array([n for _, n in signed], float) * swap_cost

    def scores(w, b):
        return np.bincount(owner, weights=w[index], minlength=len(has)) + b

    def changed(w):
        return np.bincount(c_owner, weights=c_sign * w[c_index], minlength=len(signed)) if signed else np.zeros(0)

    def gathered(per_text, per_change):
        out = np.bincount(index, weights=per_text[owner], minlength=width)
        if signed:
            out += np.bincount(c_index, weights=c_sign * per_change[c_owner], minlength=width)
        return out

    def cost(w, b):
        z = scores(w, b)
        loss = (weight * (np.logaddexp(0, z) - toxic * z)).sum()
        return loss + 0.5 * WEIGHT_COST * (w @ w) + 0.5 * (c_times * changed(w) ** 2).sum()

    w, b = np.zeros(width), 0.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(scores(w, b), -500, 500)))
        error, curve = weight * (p - toxic), np.maximum(weight * p * (1 - p), 1e-9)
        down = np.append(gathered(error, c_times * changed(w)) + WEIGHT_COST * w, error.sum())

        def product(v):
            z = curve * scores(v[:-1], v[-1])
            return np.append(gathered(z, c_times * changed(v[:-1])) + WEIGHT_COST * v[:-1], z.sum())

        step = conjugate(product, down)
        now, size = cost(w, b), 1.0
        while size > 1e-4 and cost(w - size * step[:-1], b - size * step[-1]) > now:
            size /= 2
        w, b = w - size * step[:-1], b - size * step[-1]
        if np.abs(step).max(initial=0) * size < 1e-4:
            break
    return w, float(b)


def conjugate(product, goal: np.ndarray) -> np.ndarray:
    """The solution x of product(x) = goal for a positive definite product."""
    x, rest = np.zeros(len(goal)), goal.copy()
    way, square = rest.copy(), rest @ rest
    end = square * 1e-8
    for _ in range(100):
        if square <= end:
            break
        along = product(way)
        far = square / (way @ along)
        x += far * way
        rest -= far * along
        before, square = square, rest @ rest
        way = rest + square / before * way
    return x


def score(df: DataFrame, keep: list[str], text: str, model: Model) -> DataFrame:
    """``keep`` and the score of every row's text, from 0 to 1."""
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.chosen, model.weights, model.intercept))
    name = uuid.uuid4().hex

    def batches(parts):
        chosen, weights, intercept = shared.value
        kept = worker_store()
        if kept.get("toxicity", ("",))[0] != name:
            kept["toxicity"] = (name, Lookup(chosen))
        lookup = kept["toxicity"][1]
        for batch in parts:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            sums = [intercept + float(weights[sorted(f)].sum()) for f in lookup.of_texts(texts)]
            with np.errstate(over="ignore"):
                found = 1 / (1 + np.exp(-np.array(sums, float)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, pa.float64())], names=[*keep, "score"])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, F.col(text).alias("text")).mapInArrow(batches, f"{kinds}, score double")


def held_out(key: Column) -> Column:
    """A fifth of the rows, by their id, from which nothing is learned."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic each text of ``documents`` is, learned from ``labels``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labelled(docs, labels, "doc_id", "text", "toxic", ~held_out(F.col("doc_id")))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    found = score(rows, ["doc_id", "held_out"], "text", fit(docs, "doc_id", "text", known))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
