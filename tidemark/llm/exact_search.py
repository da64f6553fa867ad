"""Exact top-k by inner product over norm buckets.

Distinct vectors are sorted by length, longest first, and cut into buckets of at most ``BUCKET`` vectors.
Buckets are searched in rounds, each round as many again times ``WIDER`` as before; after a round every
query knows the score that its k-th best so far has, its threshold. In a bucket whose longest vector has
length L, a query of length Q needs a cosine of threshold / (L * Q):

* above 1 the whole bucket is skipped for the query, before any vector moves if this holds for all
  queries of a block;
* from ``COORDINATES_FROM`` on, the query's ``FOCUS`` largest coordinates bound the coordinates of any
  vector that can reach the cosine, and only vectors within all bounds are candidates;
* below, only the vectors long enough to reach the threshold at a cosine of 1 are.

Products of candidates are then verified exactly. Pruning allows for rounding, so results are exact. Where
scores might pass 2^53 they are summed as Python integers; one beyond a long becomes the greatest or least of them.

Defined results: null vectors and those that hold null or non-finite components take no part, nor do
vectors of another length than most; zero vectors do. An empty table gives an empty result; other columns
are left alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, with_row_id, written
from tidemark.llm.vectors import classes, give_results, matrix, usual_length

BUCKET = 8_192
QUERY_BLOCK = 512
WIDER = 8
COORDINATES_FROM = 0.7
FOCUS = 4
SLACK = 1e-9

_BUCKET = "part int, number long, longest double, ids array<array<long>>, data array<array<double>>"


def buckets(known: DataFrame, width: int, total: int) -> DataFrame:
    """(bucket, longest, ids, data): rows of at most ``BUCKET`` vectors, packed; bucket 0 has the longest.

    Ranges of length are dealt to tasks, vectors of one length by their hash as well; a task sorts its
    range and packs it.
    """
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    keyed = known.select(F.col("ids"), "vector", length.alias("square"), F.xxhash64("class_id").alias("mixed"))
    parts = max(1, math.ceil(total / BUCKET))
    ranged = keyed.repartitionByRange(parts, F.desc("square"), F.col("mixed"))

    def pack(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        filled = [b for b in batches if b.num_rows]
        if filled:
            rows = pa.Table.from_batches(filled).sort_by([("square", "descending"), ("mixed", "ascending")])
            for number, start in enumerate(range(0, rows.num_rows, BUCKET)):
                piece = rows.slice(start, BUCKET)
                longest = math.sqrt(piece.column("square")[0].as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([longest], pa.float64()),
                        _one_list(piece.column("ids")), _one_list(piece.column("vector")),
                    ],
                    names=["part", "number", "longest", "ids", "data"],
                )

    return ranged.mapInArrow(pack, _BUCKET)


def _one_list(column: pa.ChunkedArray) -> pa.ListArray:
    values = column.combine_chunks()
    values = values if isinstance(values, pa.Array) else pa.concat_arrays(values.chunks)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def allowed(unit: np.ndarray, direction: np.ndarray, cosine: float, focus: int) -> np.ndarray:
    """Which rows of ``unit`` can have ``cosine`` or more with ``direction``, by its largest coordinates.

    The angle between a vector and an axis differs from the query's by at most the angle of ``cosine``. So
    with x the query's coordinate, y lies between x * cosine -+ sqrt((1 - x^2)(1 - cosine^2)), and where the
    axis itself is within that angle of the query (or its opposite) there is no bound on that side.
    """
    keep = np.ones(len(unit), bool)
    for f in np.argsort(-np.abs(direction))[:focus]:
        x = direction[f]
        reach = math.sqrt(max(0.0, (1 - x * x) * (1 - cosine * cosine)))
        if x > -cosine:
            keep &= unit[:, f] >= x * cosine - reach - SLACK
        if x < cosine:
            keep &= unit[:, f] <= x * cosine + reach + SLACK
    return keep


def bucket_hits(data, first, queries, thresholds, limit: int):
    """(query, row, score) of the rows of one bucket that can be among a query's ``limit`` best.

    ``first`` has the smallest id behind each vector. ``data`` is sorted by length.
    """
    lengths = np.sqrt((data**2).sum(1))
    own = np.sqrt((queries**2).sum(1))
    large = float(np.abs(data).max(initial=0)) * float(np.abs(queries).max(initial=0)) * data.shape[1] >= 2**53
    unit = data / np.where(lengths > 0, lengths, 1)[:, None]
    by_length = []
    for q, threshold in enumerate(thresholds):
        reach = lengths[0] * own[q]
        rows = None
        if threshold > 0 and reach > 0:
            cosine = threshold / reach
            if cosine > 1 + SLACK:
                continue
            if cosine >= COORDINATES_FROM:
                rows = np.flatnonzero(allowed(unit, queries[q] / own[q], min(1.0, cosine) - SLACK, FOCUS))
            else:
                need = threshold / own[q] * (1 - SLACK)
                by_length.append((q, int(np.searchsorted(-lengths, -need, side="right"))))
                continue
        elif threshold > 0:
            continue
        if rows is None:
            by_length.append((q, len(data)))
        elif len(rows):
            yield from best(q, rows, products(data[rows], queries[q : q + 1], large)[0], threshold, first, limit)
    if by_length:
        asked = np.array([q for q, _ in by_length])
        most = max(n for _, n in by_length)
        scores = products(data[:most], queries[asked], large)
        for (q, n), row in zip(by_length, scores):
            yield from best(q, np.arange(n), row[:n], thresholds[q], first, limit)


def products(data: np.ndarray, queries: np.ndarray, large: bool) -> np.ndarray:
    """Exact products, a row per query."""
    if not large:
        return queries @ data.T
    whole = np.array([[int(x) for x in row] for row in data.tolist()], object).reshape(data.shape)
    return np.array([[sum(map(int.__mul__, map(int, q), v)) for v in whole.tolist()] for q in queries.tolist()], object).reshape(
        len(queries), len(data)
    )


def best(q: int, rows, scores, threshold: float, first, limit: int):
    reached = np.flatnonzero(scores >= threshold) if threshold > -math.inf else np.arange(len(rows))
    if len(reached) > limit:
        lowest = np.partition(scores[reached], len(reached) - limit)[len(reached) - limit]
        reached = reached[scores[reached] >= lowest]
    # Each class has a row at least, so the first of them by score and id suffice.
    order = sorted(reached.tolist(), key=lambda i: (-scores[i], first[rows[i]]))[:limit]
    for i in order:
        yield q, int(rows[i]), max(1 - 2**63, min(2**63 - 1, int(scores[i])))


def search(df: DataFrame, ids: str, components, is_query, limit: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``limit`` best rows for each row with ``is_query``.

    ``components`` is an array<double> of whole numbers.
    """
    rows = df.select(df[ids].cast("long").alias("id"), is_query.alias("asked"), components.alias("vector"))
    width, keep = usual_length(rows, "vector"), limit + 1
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("id").isNotNull() & (F.size("vector") == width) & usable)
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    known = classes(rows, keep)
    packed = written(buckets(known, width, known.count()), "buckets")
    heads = packed.select("part", "number", "longest")
    # One number per bucket; buckets follow each other by part, then by number within it.
    per_part = {r["part"]: r["count"] for r in heads.groupBy("part").count().collect()}
    begins, at = {}, 0
    for part in sorted(per_part):
        begins[part], at = at, at + per_part[part]
    packed = packed.select((_lookup(begins) + F.col("number")).alias("bucket"), "longest", "ids", "data")
    members = rows.where("asked").select(F.col("id").alias("query_id"), "vector").distinct()
    queries = written(members.join(known.select("class_id", "vector"), "vector").select("query_id", "class_id", "vector"), "queries")
    distinct = queries.select("class_id", "vector").dropDuplicates(["class_id"])
    asked = written(with_row_id(distinct, "serial"), "asked")
    block = F.pmod(F.xxhash64("class_id"), F.lit(max(1, math.ceil(asked.count() / QUERY_BLOCK)))).alias("block")
    asked = asked.select("class_id", "vector", block)
    found, done, step = None, 0, 2
    while done < at:
        upto = min(at, done + step)
        found = written(_round(asked, packed, found, done, upto, limit), "hits")
        done, step = upto, step * WIDER
    if found is None:
        found = df.sparkSession.createDataFrame([], "class_id long, ids array<long>, score long")
    return give_results(queries.select("query_id", "class_id"), found.select("class_id", "ids", "score"), limit, ascending=False)


def _lookup(begins: dict[int, int]):
    """The bucket number at which a part begins: a row per range partition, as many as the cluster deals."""
    if not begins:
        return F.lit(0).cast("long")
    return F.create_map(*[F.lit(x) for pair in begins.items() for x in pair])[F.col("part")].cast("long")


def _round(asked: DataFrame, packed: DataFrame, found: DataFrame | None, begin: int, end: int, limit: int) -> DataFrame:
    """The best hits so far and those of buckets ``begin`` to ``end``, merged per query."""
    keep = limit + 1
    if found is None:
        known = asked.withColumn("threshold", F.lit(-math.inf))
    else:
        # Rows, not classes, count towards the k-th best; the query's own row may be among them.
        each = found.select("class_id", "score", F.explode("ids").alias("vec_id"))
        ranked = each.groupBy("class_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
        least = ranked.select("class_id", F.get("scores", F.lit(keep - 1)).cast("double").alias("threshold"))
        known = asked.join(least, "class_id", "left").withColumn("threshold", F.coalesce("threshold", F.lit(-math.inf)))
    blocks = known.groupBy("block").agg(F.collect_list(F.struct("class_id", "vector", "threshold")).alias("queries"))
    # The shortest bucket that matters to a block; an infinite need is no need.
    own = lambda q: F.sqrt(F.aggregate(q["vector"], F.lit(0.0), lambda a, x: a + x * x))
    need = F.array_min(F.transform("queries", lambda q: F.when(own(q) > 0, q["threshold"] / own(q)).otherwise(-math.inf)))
    blocks = blocks.withColumn("need", need * (1 - SLACK))
    pairs = blocks.select("block", "need", F.explode(F.sequence(F.lit(begin), F.lit(end - 1))).alias("bucket"))
    heads = packed.select("bucket", "longest")
    pairs = pairs.join(heads, "bucket").where("longest >= need").select("block", F.col("bucket").cast("long").alias("bucket"))
    work = pairs.join(packed.select("bucket", "ids", "data"), "bucket").join(blocks.select("block", "queries"), "block")

    def verify(parts):
        for batch in parts:
            for i in range(len(batch)):
                v, ids, q = batch.column("data")[i].values, batch.column("ids")[i].values, batch.column("queries")[i].values
                width = len(v[0])
                first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
                thresholds = q.field("threshold").to_numpy()
                hits = list(
                    bucket_hits(matrix(v, width), first, matrix(q.field("vector"), width), thresholds, keep)
                )
                if hits:
                    a, b, s = zip(*hits)
                    columns = [q.field("class_id").take(pa.array(a)), ids.take(pa.array(b)), pa.array(s, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["class_id", "ids", "score"])

    hits = work.select("data", "ids", "queries").mapInArrow(verify, "class_id long, ids array<long>, score long")
    if found is not None:
        hits = hits.unionByName(found.select("class_id", "ids", "score"))
    order = F.struct((-F.col("score")).alias("order"), F.element_at("ids", 1).alias("first"), "ids", "score")
    # At most ``keep`` hits come from a bucket, so a query's list is bounded by the buckets of the round.
    best_hits = hits.groupBy("class_id").agg(F.slice(F.sort_array(F.collect_list(order)), 1, keep).alias("hits"))
    return best_hits.select("class_id", F.explode("hits").alias("hit")).select("class_id", "hit.ids", "hit.score")


def op6_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows by integer inner product for every fiftieth row of ``embeddings``."""
    vectors = table(spark, sf_dir, "embeddings")
    whole = F.transform(F.col("embedding").cast("array<double>"), _floor_256)
    return search(vectors, "vec_id", whole, F.col("vec_id") % 50 == 0)


def _floor_256(x):
    """floor(256 x) as a double; what is not finite stays so."""
    scaled = x * F.lit(256.0)
    # Doubles from 2^52 on are whole, and a cast to long could cut them.
    return F.when(F.abs(scaled) < F.lit(2.0**52), F.floor(scaled).cast("double")).otherwise(scaled)


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id as vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s)
select query_id, n::int as rank, vec_id, score from r where n <= 5"""
