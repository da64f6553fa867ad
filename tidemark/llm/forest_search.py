"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are grown on the driver from a bounded sample (``SAMPLE`` distinct vectors, those with the smallest
hash): a node draws two vectors, moves them to the centres of the halves they attract, projects on their
difference and splits at the median; a node of ``LEAF`` sampled vectors or fewer is a leaf. Every vector of
the table is then routed to its leaf in every tree. A query walks all trees at once through one priority
queue, nearest side first, and takes leaves until they hold ``VISIT`` of the sampled vectors, each counted once
however many trees show it (exact up to ``SAMPLE`` distinct vectors, an estimate beyond); candidates are
reranked by their exact distance.

How much must be visited depends on the data. Vectors without structure, such as points spread evenly in 64
dimensions, have neighbours hardly nearer than the rest and need most of the table for a recall of
0.9; clustered ones need far less. ``VISIT`` is a share, so recall is the same at every size.

A vector that more rows hold than a query asks for, and more than one row in ``HEAVY``, can fill a query's whole
answer, so the vectors of this kind, at most ``HEAVY`` of them, are candidates of every query and stay outside
the trees.

Neighbouring leaves of a tree form a group. A group's vectors are dealt into blocks of bounded size, and
queries into blocks as well; a task gets one block of each and multiplies leaf by leaf.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do
vectors of another length than most; repeated ids count once per distinct vector; an empty table gives an
empty result; other columns are left alone.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, written
from tidemark.llm.vectors import classes, give_results, matrix, usual_length

SAMPLE = 20_000
TREES = 8
LEAF = 64
VISIT = 0.9
HEAVY = 1_000
GROUPS = 8
BLOCK = 8_192
QUERY_BLOCK = 1_024


class Tree:
    """Nodes in depth-first order; ``low`` and ``high`` are children, -1 at leaves."""

    def __init__(self, normal: np.ndarray, cut: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.normal, self.cut, self.low, self.high = normal, cut, low, high

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.normal, self.cut, self.low, self.high

    @classmethod
    def grown(cls, sample: np.ndarray, leaf: int, seed: int) -> Tree:
        random = np.random.default_rng(seed)
        normals: list[np.ndarray] = []
        cuts: list[float] = []
        low: list[int] = []
        high: list[int] = []
        todo = [(np.arange(len(sample)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            node = len(cuts)
            if parent >= 0:
                (high if side else low)[parent] = node
            split = cls.split(sample[rows], random) if len(rows) > leaf else None
            normals.append(split[0] if split else np.zeros(sample.shape[1]))
            cuts.append(split[1] if split else 0.0)
            low.append(-1)
            high.append(-1)
            if split:
                above = sample[rows] @ split[0] > split[1]
                todo += [(rows[above], node, 1), (rows[~above], node, 0)]
        return cls(np.array(normals), np.array(cuts), np.array(low), np.array(high))

    @staticmethod
    def split(points: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, float] | None:
        """Normal and cut of a plane with points on both sides, or None after a few draws."""
        for _ in range(5):
            a, b = points[random.choice(len(points), 2, replace=False)]
            for _ in range(6):
                nearer = points @ (a - b) > (a + b) @ (a - b) / 2
                if nearer.all() or not nearer.any():
                    break
                a, b = points[nearer].mean(0), points[~nearer].mean(0)
            length = np.linalg.norm(a - b)
            if not length > 0:
                continue
            normal = (a - b) / length
            cut = float(np.median(points @ normal))
            if 0 < (points @ normal > cut).sum() < len(points):
                return normal, cut
        return None

    def route(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        leaf = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if self.low[node] < 0:
                leaf[rows] = node
            elif len(rows):
                above = points[rows] @ self.normal[node] > self.cut[node]
                todo += [(self.high[node], rows[above]), (self.low[node], rows[~above])]
        return leaf


def visited_leaves(
    trees: list[Tree], held: list[np.ndarray], query: np.ndarray, enough: float, sampled: list[list[np.ndarray]] | None = None
) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue, until they hold ``enough`` vectors.

    ``held`` has the number of vectors per node. ``sampled`` has the sampled vectors per node; with it,
    ``enough`` is a number of distinct sampled vectors, otherwise what the trees hold together.
    """
    seen = np.zeros(sum(map(len, sampled[0])), bool) if sampled else None
    margins = [t.normal @ query - t.cut for t in trees]
    queue = [(-math.inf, t, 0) for t in range(len(trees))]
    heapq.heapify(queue)
    found, total = [], 0
    while queue and total < enough:
        far, t, node = heapq.heappop(queue)
        tree = trees[t]
        if tree.low[node] < 0:
            if held[t][node]:
                found.append((t, node))
                if seen is None:
                    total += held[t][node]
                else:
                    rows = sampled[t][node]
                    total += len(rows) - int(seen[rows].sum())
                    seen[rows] = True
            continue
        margin = margins[t][node]
        heapq.heappush(queue, (max(far, -margin), t, int(tree.high[node])))
        heapq.heappush(queue, (max(far, margin), t, int(tree.low[node])))
    return found


def nearest_in_leaves(vectors, leaf_of, ids, queries, leaves, keep: int):
    """For each query its ``keep`` nearest rows among those whose leaf it visits: (query, row, distance)."""
    order = np.argsort(leaf_of, kind="stable")
    vectors, leaf_of, first = vectors[order], leaf_of[order], ids[order]
    starts = np.flatnonzero(np.concatenate([[True], leaf_of[1:] != leaf_of[:-1]]))
    ends = np.concatenate([starts[1:], [len(leaf_of)]])
    visitors: dict[int, list[int]] = {}
    for q, visits in enumerate(leaves):
        for leaf in visits:
            visitors.setdefault(leaf, []).append(q)
    squares, own = (vectors**2).sum(1), (queries**2).sum(1)
    near = np.full((len(queries), 0), np.inf)
    gathered: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
    for a, b in zip(starts, ends):
        asking = np.array(visitors.get(int(leaf_of[a]), []), np.int64)
        if len(asking):
            rough = own[asking, None] + squares[None, a:b] - 2 * queries[asking] @ vectors[a:b].T
            if b - a > 2 * keep:
                top = np.argpartition(rough, keep + 4, axis=1)[:, : keep + 5]
                limit = np.take_along_axis(rough, top, 1).max(1)
            else:
                limit = np.full(len(asking), np.inf)
            # Rounding must not decide: everything near the limit goes on to the exact distance.
            slack = 1e-9 * (own[asking] + squares[a:b].max())
            for i, q in enumerate(asking):
                rows = np.flatnonzero(rough[i] <= limit[i] + slack[i]) + a
                gathered[q].append((rows, rough[i, rows - a]))
    for q, parts in enumerate(gathered):
        if parts:
            rows = np.concatenate([r for r, _ in parts])
            rough = np.concatenate([d for _, d in parts])
            if len(rows) > keep:
                limit = np.partition(rough, keep - 1)[keep - 1] + 1e-9 * (own[q] + squares.max())
                rows = rows[rough <= limit]
            distance = np.sqrt(((vectors[rows] - queries[q]) ** 2).sum(1))
            best = np.lexsort((first[rows], distance))[:keep]
            for row, d in zip(rows[best], distance[best]):
                yield q, order[row], d


def search(
    df: DataFrame,
    ids: str,
    vector: str,
    is_query,
    limit: int = 10,
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    visit: float = VISIT,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``limit`` nearest rows found for each row with ``is_query``."""
    spark = df.sparkSession
    width, keep = usual_length(df, vector), limit + 1
    rows = df.select(df[ids].cast("long").alias("id"), is_query.alias("asked"), F.col(vector).cast("array<double>").alias("vector"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("id").isNotNull() & (F.size("vector") == width) & usable & F.exists("vector", lambda x: x != 0))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    every = classes(rows, keep)
    held_by = rows.groupBy("vector").agg(F.count("*").alias("n"))
    many = held_by.where((F.col("n") > limit) & (F.col("n") * HEAVY > rows.count())).select("vector")
    often = [r["class_id"] for r in every.join(many, "vector").select("class_id").collect()]
    heavy = spark.sparkContext.broadcast([(r["vector"], r["ids"]) for r in every.where(F.col("class_id").isin(often)).collect()])
    known = every.where(~F.col("class_id").isin(often))
    points = known.orderBy(F.xxhash64("vector"), "vector").limit(sample).select("vector").toArrow()
    at_points = matrix(points.column(0).combine_chunks(), max(width, 1))
    grown = [Tree.grown(at_points, leaf, seed) for seed in range(trees)]
    forest = spark.sparkContext.broadcast([tree.arrays() for tree in grown])
    sampled_in = spark.sparkContext.broadcast([tree.route(at_points).astype(np.int32) for tree in grown])

    def route(parts):
        walked = [Tree(*arrays) for arrays in forest.value]
        for batch in parts:
            at = matrix(batch.column(1), width)
            leaves = np.stack([tree.route(at) for tree in walked], 1).tolist()
            columns = [*batch.columns, pa.array(leaves, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["class_id", "vector", "ids", "leaves"])

    shape = "class_id long, vector array<double>, ids array<long>, leaves array<int>"
    routed = written(known.mapInArrow(route, shape), "routed")
    per_leaf = routed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()
    plan = spark.sparkContext.broadcast(_plan(grown, per_leaf))
    query_blocks = max(1, math.ceil(rows.where("asked").count() / QUERY_BLOCK))
    # An answer needs ``keep`` vectors, where the table has them.
    enough = max(visit * len(at_points), min(keep, len(at_points)))

    def ask(parts):
        held, group_of, _ = plan.value
        walked = [Tree(*arrays) for arrays in forest.value]
        sampled = [_per_node(leaf_of, len(tree.cut)) for leaf_of, tree in zip(sampled_in.value, walked)]
        for batch in parts:
            out = []
            for class_id, query in zip(batch.column(0).to_pylist(), matrix(batch.column(1), width)):
                visits: dict[int, list[int]] = {}
                for t, node in visited_leaves(walked, held, query, enough, sampled):
                    visits.setdefault(int(group_of[t][node]), []).append(node)
                out += [(g, class_id, query, nodes) for g, nodes in visits.items()]
            if out:
                g, c, q, n = zip(*out)
                arrays = [pa.array(g, pa.int32()), pa.array(c, pa.int64()), pa.array(list(q), pa.list_(pa.float64())), pa.array(n, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["group", "query", "at", "visits"])

    def deal(parts):
        _, group_of, blocks = plan.value
        for batch in parts:
            leaves = np.array(batch.column("leaves").to_pylist(), np.int64).reshape(len(batch), trees)
            for t in range(trees):
                groups = group_of[t][leaves[:, t]]
                block = _mixed(batch.column("class_id").to_numpy()) % blocks[groups]
                arrays = [pa.array(groups, pa.int32()), pa.array(block, pa.int32()), pa.array(leaves[:, t], pa.int32()), *batch.columns[:3]]
                yield pa.RecordBatch.from_arrays(arrays, names=["group", "block", "leaf", "class_id", "vector", "ids"])

    dealt = routed.mapInArrow(deal, "group int, block int, leaf int, class_id long, vector array<double>, ids array<long>")
    packed = dealt.groupBy("group", "block").agg(F.collect_list(F.struct("leaf", F.element_at("ids", 1).alias("first"), "vector", "ids")).alias("rows"))
    members = rows.where("asked").select(F.col("id").alias("query_id"), "vector").distinct()
    queries = written(members.join(every.select("class_id", "vector"), "vector").select("query_id", "class_id", "vector"), "queries")
    distinct = queries.select("class_id", "vector").dropDuplicates(["class_id"])
    asked = distinct.mapInArrow(ask, "group int, query long, at array<double>, visits array<int>")
    in_blocks = asked.groupBy("group", F.pmod(F.xxhash64("query"), F.lit(query_blocks)).alias("part")).agg(
        F.collect_list(F.struct("query", "at", "visits")).alias("queries")
    )

    def rerank(parts):
        for batch in parts:
            for vectors, queries in zip(batch.column("rows"), batch.column("queries")):
                v, q = vectors.values, queries.values
                ids = v.field("first").to_numpy()
                hits = list(
                    nearest_in_leaves(
                        matrix(v.field("vector"), width), v.field("leaf").to_numpy(), ids,
                        matrix(q.field("at"), width), q.field("visits").to_pylist(), keep,
                    )
                )
                if hits:
                    a, b, d = zip(*hits)
                    columns = [q.field("query").take(pa.array(a)), v.field("ids").take(pa.array(b)), pa.array(d, pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["class_id", "ids", "score"])

    def rerank_heavy(parts):
        points = np.array([v for v, _ in heavy.value]).reshape(-1, width)
        first = np.array([ids[0] for _, ids in heavy.value], np.int64)
        for batch in parts:
            for class_id, query in zip(batch.column(0).to_pylist(), matrix(batch.column(1), width)):
                distance = np.sqrt(((points - query) ** 2).sum(1))
                best = np.lexsort((first, distance))[:keep].tolist()
                if best:
                    columns = [pa.array([class_id] * len(best), pa.int64()), pa.array([heavy.value[i][1] for i in best], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(distance[best])], names=["class_id", "ids", "score"])

    shape = "class_id long, ids array<long>, score double"
    pairs = packed.join(in_blocks, "group").select("rows", "queries")
    found = pairs.mapInArrow(rerank, shape).union(distinct.mapInArrow(rerank_heavy, shape))
    return give_results(queries.select("query_id", "class_id"), found, limit, ascending=True)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Non-negative numbers that spread patterned ids evenly."""
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64)


def _per_node(leaf_of: np.ndarray, nodes: int) -> list[np.ndarray]:
    """The rows that lie in each node; only leaves have any."""
    order = np.argsort(leaf_of, kind="stable")
    return np.split(order, np.searchsorted(leaf_of[order], np.arange(1, nodes)))


def _plan(trees: list[Tree], per_leaf) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Vectors per node, group of each leaf, blocks per group. Groups are runs of leaves of like weight."""
    held = [np.zeros(len(t.cut), np.int64) for t in trees]
    for row in per_leaf:
        held[row["tree"]][row["leaf"]] = row["count"]
    group_of, weights = [], []
    for t, counts in enumerate(held):
        share = max(1, counts.sum())
        group = t * GROUPS + np.minimum(GROUPS - 1, (np.cumsum(counts) - counts) * GROUPS // share)
        group_of.append(group)
        weights.append(np.bincount(group - t * GROUPS, weights=counts, minlength=GROUPS))
    blocks = np.maximum(1, np.ceil(np.concatenate(weights) / BLOCK)).astype(np.int64)
    return held, group_of, blocks


def op2_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows found for every hundredth row of ``embeddings``."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, "vec_id", "embedding", F.col("vec_id") % 100 == 0)
