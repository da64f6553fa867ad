"""Hard negatives: blocks along a Hilbert curve, read where interval bounds say that a window can be met.

Distinct vectors are sorted along a Hilbert curve (dimensions in order of falling spread, ``BITS`` bits each) and
written as a Parquet table of blocks of at most ``BLOCK`` vectors, each with the least and greatest value per
dimension (its zone map) and the labels in it. Anchors are packed along the same curve into groups of ``GROUP``.

What an anchor looks for is a window of scores: its positives are the best of its label, a window without
an upper end; the negatives of a positive are the best of other labels within a window that the positive's score
fixes. For an anchor q and a block's zone map, interval arithmetic bounds every inner product: the sum over the
dimensions of the least and of the greatest of q_i * low_i and q_i * high_i. A block is read for a window only if the
two intervals meet and the block has a label that will do. Windows are first looked up in the anchor's own block,
which the curve filled with its neighbours; the least score that these hits leave to be beaten raises the lower end
of the window before all other blocks are judged.

Bounds are widened for rounding and products are exact, so results are those of a full comparison. Scores that
might pass 2^53 are summed as Python integers; one beyond a long counts as the greatest or least long.

Defined results: rows with a null id, label or vector, or null or non-finite components, take no part, nor do vectors
of another length than most; zero vectors do. Rows that agree in id, label and vector count once; rows that share an
id and differ are different rows. Ties go to the smaller id. A positive with a negative score has no window.
An empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, written
from tidemark.llm.vectors import SALTS, classes, matrix, usual_length

BITS = 4
BLOCK = 1_024
GROUP = 1_024
ZONES = 512
PER_TASK = 8
SLACK = 1e-9
LEAST, GREATEST = 1 - 2**63, 2**63 - 1

_BLOCK = "block long, low array<double>, high array<double>, labels array<long>, kind string, data binary"
_HITS = "array<struct<order: long, id: long, class_id: long>>"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (whole numbers below 2^bits) on the Hilbert curve, as rows of bytes that
    sort like the places."""
    x = cells.astype(np.uint32).T.copy()
    width = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        rest = np.uint32(level - 1)
        for i in range(width):
            turned = (x[i] & level) != 0
            x[0] = np.where(turned, x[0] ^ rest, x[0])
            swapped = np.where(turned, 0, (x[0] ^ x[i]) & rest).astype(np.uint32)
            x[0] ^= swapped
            x[i] ^= swapped
        level >>= 1
    for i in range(1, width):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((x[width - 1] & level) != 0, turn ^ np.uint32(level - 1), turn)
        level >>= 1
    x ^= turn
    # The highest bits of all dimensions first, then the next ones.
    planes = [((x >> np.uint32(b)) & 1).T for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def spread(known: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The dimensions in order of falling spread, and the range of each in which most values lie."""

    def sums(parts):
        n, total, squares = 0, np.zeros(width), np.zeros(width)
        for batch in parts:
            v = matrix(batch.column(0), width)
            n, total, squares = n + len(v), total + v.sum(0), squares + (v**2).sum(0)
        columns = [pa.array(np.arange(width)), pa.array(np.full(width, float(n))), pa.array(total), pa.array(squares)]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "n", "total", "squares"])

    summed = known.select("vector").mapInArrow(sums, "dim long, n double, total double, squares double")
    found = summed.groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).orderBy("dim").toPandas()
    n = np.maximum(1, found["n"].to_numpy())
    mean = found["total"].to_numpy() / n
    around = np.sqrt(np.maximum(0, found["squares"].to_numpy() / n - mean**2))
    return np.argsort(-around, kind="stable"), mean - 2 * around, mean + 2 * around


def along_curve(known: DataFrame, width: int) -> DataFrame:
    """``known`` with ``place``, its vector's place on the curve."""
    order, low, high = spread(known, width)
    size = np.where(high > low, high - low, 1.0)

    def places(parts):
        for batch in parts:
            v = matrix(batch.column("vector"), width)
            cells = np.clip(np.floor((v - low) / size * 2**BITS), 0, 2**BITS - 1)[:, order]
            found = [r.tobytes() for r in hilbert(cells, BITS)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, "place"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in known.schema)
    return known.mapInArrow(places, f"{kinds}, place binary")


def packed(rows: DataFrame, size: int, total: int, width: int, more: dict[str, str]) -> DataFrame:
    """Rows (class_id, place, label, vector, ...) sorted along the curve, ``size`` per block; ``more`` columns, by
    name and type, become arrays beside ``class_ids``."""
    parts = max(1, math.ceil(total / (size * PER_TASK)))
    ranged = rows.repartitionByRange(parts, "place", F.xxhash64("class_id")).sortWithinPartitions("place", "class_id")

    def pack(batches):
        from pyspark import TaskContext

        part, number, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            held.append(batch)
            count = sum(map(len, held))
            whole = pa.Table.from_batches(held) if count >= size else None
            while count >= size:
                yield _block(whole.slice(0, size), part, number, width, more)
                whole, count, number = whole.slice(size), count - size, number + 1
                held = whole.to_batches()
        if any(map(len, held)):
            yield _block(pa.Table.from_batches(held), part, number, width, more)

    arrays = "".join(f", {name} array<{kind}>" for name, kind in {"class_ids": "long", "label_of": "long", **more}.items())
    chosen = ranged.select("class_id", "label", "vector", *more)
    return chosen.mapInArrow(pack, _BLOCK + arrays)


def _block(rows: pa.Table, part: int, number: int, width: int, more: dict) -> pa.RecordBatch:
    def listed(name: str):
        values = rows.column(name).combine_chunks()
        values = values if isinstance(values, pa.Array) else pa.concat_arrays(values.chunks)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    data = matrix(listed("vector").values, width)
    most = np.abs(data).max(initial=0)
    kind = next((k for k, limit in (("<i2", 2**15), ("<i4", 2**31)) if most < limit), "<f8")
    labels = np.unique(rows.column("label").to_numpy())
    fixed = {
        "block": pa.array([(part << 32) + number], pa.int64()), "low": _list(data.min(0)), "high": _list(data.max(0)),
        "labels": _list(labels), "kind": pa.array([kind]), "data": pa.array([data.astype(kind).tobytes()], pa.binary()),
        "class_ids": listed("class_id"), "label_of": listed("label"), **{name: listed(name) for name in more},
    }
    return pa.RecordBatch.from_arrays(list(fixed.values()), names=list(fixed))


def _list(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _vectors(kind: str, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, kind).astype(float).reshape(-1, width)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per query (row) and box (column) what an inner product is at least and at most."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    room = (np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T) * SLACK
    return least - room, most + room


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products as longs, a row per query."""
    if float(np.abs(data).max(initial=0)) * float(np.abs(queries).max(initial=0)) * data.shape[1] < 2**53:
        return (queries @ data.T).astype(np.int64)
    whole = [[int(x) for x in v] for v in data.tolist()]
    asked = [[int(x) for x in q] for q in queries.tolist()]
    exact = [[max(LEAST, min(GREATEST, sum(map(int.__mul__, q, v)))) for v in whole] for q in asked]
    return np.array(exact, np.int64).reshape(len(queries), len(data))


def _choose(groups: DataFrame, blocks: DataFrame, width: int, same: bool) -> DataFrame:
    """(group, block, wants): the blocks that windows of a group must read. Zone maps meet groups in chunks."""
    zones = blocks.select("block", "low", "high", "labels")
    chunks = max(1, math.ceil(zones.count() / ZONES))
    zone = F.struct("block", "low", "high", "labels")
    chunked = zones.groupBy(F.pmod(F.xxhash64("block"), F.lit(chunks)).alias("chunk")).agg(F.collect_list(zone).alias("zones"))
    each = groups.select("block", "kind", "data", "label_of", "wants", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    met = each.withColumn("chunk", F.col("chunk").cast("long")).join(chunked, "chunk")

    def choose(parts):
        for batch in parts:
            for i in range(len(batch)):
                zone, want = batch.column("zones")[i].values, batch.column("wants")[i].values
                queries = _vectors(batch.column("kind")[i].as_py(), batch.column("data")[i].as_py(), width)
                least, most = bounds(queries, matrix(zone.field("low"), width), matrix(zone.field("high"), width))
                member, low, high = (want.field(n).to_numpy() for n in ("member", "low", "high"))
                # An end of the range of a long is no end: scores beyond it count as that end.
                fits = (most[member] >= np.where(low == LEAST, -np.inf, low)[:, None]) & (
                    least[member] <= np.where(high == GREATEST, np.inf, high)[:, None]
                )
                held = zone.field("labels").to_pylist()
                labels = np.array(batch.column("label_of")[i].as_py())
                for label in np.unique(labels).tolist():
                    usable = np.array([label in h if same else len(h) > (label in h) for h in held])
                    fits[np.ix_(labels[member] == label, ~usable)] = False
                at, chosen = np.nonzero(fits.T)
                used, begin = np.unique(at, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array([*begin, len(at)], pa.int32()), pa.array(chosen.astype(np.int32)))
                group = np.full(len(used), batch.column("block")[i].as_py())
                blocks_ = zone.field("block").to_numpy()[used]
                yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(blocks_), lists], names=["group", "block", "chosen"])

    chosen = met.select("block", "kind", "data", "label_of", "wants", "zones")
    return chosen.mapInArrow(choose, "group long, block long, chosen array<int>")


def _at_home(groups: DataFrame, homes: DataFrame) -> DataFrame:
    """(group, block, chosen): every window with the block of its own anchor."""
    each = groups.select(F.col("block").alias("group"), "class_ids", F.posexplode("wants").alias("want", "w"))
    each = each.select("group", "want", F.element_at("class_ids", F.col("w.member") + 1).alias("class_id"))
    return each.join(homes, "class_id").groupBy("group", "block").agg(F.collect_list("want").alias("chosen"))


def _visit(pairs: DataFrame, groups: DataFrame, blocks: DataFrame, width: int, same: bool, keep: int) -> DataFrame:
    """(class_id, number, hits): the ``keep`` best rows in every window, over the blocks of ``pairs``."""
    read = blocks.select("block", "kind", "data", "class_ids", "label_of", "ids")
    asked = groups.select(
        F.col("block").alias("group"), F.col("kind").alias("q_kind"), F.col("data").alias("q_data"),
        F.col("class_ids").alias("q_ids"), F.col("label_of").alias("q_labels"), "wants",
    )
    work = pairs.join(read, "block").join(asked, "group")

    def verify(parts):
        for batch in parts:
            for i in range(len(batch)):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                found = list(_in_block(row, width, same, keep))
                classes_, numbers, hits = zip(*found) if found else ((), (), ())
                kind = pa.list_(pa.struct([("order", pa.int64()), ("id", pa.int64()), ("class_id", pa.int64())]))
                columns = [pa.array(classes_, pa.int64()), pa.array(numbers, pa.int32()), pa.array(hits, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["class_id", "number", "hits"])

    chosen = work.select("kind", "data", "class_ids", "label_of", "ids", "q_kind", "q_data", "q_ids", "q_labels", "wants", "chosen")
    hits = chosen.mapInArrow(verify, f"class_id long, number int, hits {_HITS}")
    best = F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, keep).alias("hits")
    # A window has ``keep`` hits per block, cut to ``keep`` by salt first.
    salted = hits.groupBy("class_id", "number", F.pmod(F.xxhash64("hits"), F.lit(SALTS)).alias("salt")).agg(best)
    return salted.groupBy("class_id", "number").agg(best)


def _in_block(row: dict, width: int, same: bool, keep: int):
    """(class, number, hits) of the chosen windows in one block."""
    ids = row["ids"].values
    first = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
    # Rows by their first id, so that a stable sort by score leaves ties in order of ids.
    by_id = np.argsort(first, kind="stable")
    data = _vectors(row["kind"].as_py(), row["data"].as_py(), width)[by_id]
    names, labels = row["class_ids"].values.to_numpy()[by_id], row["label_of"].values.to_numpy()[by_id]
    queries = _vectors(row["q_kind"].as_py(), row["q_data"].as_py(), width)
    q_ids, q_labels = row["q_ids"].values.to_numpy(), row["q_labels"].values.to_numpy()
    chosen = row["chosen"].values.to_numpy()
    want = row["wants"].values
    member, number, low, high = (want.field(n).to_numpy()[chosen] for n in ("member", "number", "low", "high"))
    for m in np.unique(member).tolist():
        usable = np.flatnonzero((labels == q_labels[m]) == same)
        score = products(queries[m : m + 1], data[usable])[0]
        order = np.argsort(-score, kind="stable")
        falling = -score[order]
        for w in np.flatnonzero(member == m).tolist():
            start = int(np.searchsorted(falling, -int(high[w]), side="left"))
            end = min(start + keep, int(np.searchsorted(falling, -int(low[w]), side="right")))
            # Each class has a row at least, so the first classes by score and first id suffice.
            best = zip(usable[order[start:end]].tolist(), falling[start:end].tolist())
            hits = [(s, k, int(names[r])) for r, s in best for k in ids[int(by_id[r])].as_py()]
            if hits:
                kept = sorted(hits)[:keep]
                yield int(q_ids[m]), int(number[w]), [dict(zip(("order", "id", "class_id"), h)) for h in kept]


_WINDOW = ("number", "low", "high")


def _groups(rows: DataFrame, width: int) -> DataFrame:
    """Rows (class_id, place, label, vector, windows) in groups, with the windows of all members as ``wants``; written."""
    groups = packed(rows, GROUP, rows.count(), width, {"windows": "array<struct<number: int, low: long, high: long>>"})
    def of_member(windows, i):
        return F.transform(windows, lambda w: F.struct(i.cast("int").alias("member"), *[w[n].alias(n) for n in _WINDOW]))

    member = F.transform("windows", of_member)
    return written(groups.withColumn("wants", F.flatten(member)).drop("windows", "low", "high", "labels"), "groups")


def _window(number, low, high) -> Column:
    return F.struct(number.cast("int").alias("number"), low.cast("long").alias("low"), high.cast("long").alias("high"))


def _two_rounds(asked: DataFrame, blocks: DataFrame, width: int, windows: DataFrame, same: bool, keep: int) -> DataFrame:
    """(class_id, number, hits) for ``windows`` (class_id, number, low, high) of the anchors ``asked``, written.

    The first round looks at the anchors' own blocks, and its hits raise the windows' lower ends for the second.
    """
    homes = blocks.select("block", F.explode("class_ids").alias("class_id"))
    per_anchor = F.collect_list(_window(F.col("number"), F.col("low"), F.col("high"))).alias("windows")

    def asking(ends: DataFrame) -> DataFrame:
        rows = written(asked.join(ends.groupBy("class_id").agg(per_anchor), "class_id"), "asking")
        return _groups(rows, width)

    groups = asking(windows)
    seen = _visit(_at_home(groups, homes), groups, blocks, width, same, keep)
    beaten = F.get("hits", F.lit(keep - 1))["order"]
    raised = windows.join(seen.select("class_id", "number", (-beaten).alias("least")), ["class_id", "number"], "left")
    raised = raised.select("class_id", "number", F.greatest("low", F.coalesce("least", "low")).alias("low"), "high")
    groups = asking(written(raised, "windows"))
    return written(_visit(_choose(groups, blocks, width, same), groups, blocks, width, same, keep), "hits")


def mine(
    df: DataFrame,
    ids: str,
    label: str,
    components: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``components`` is an array<double> of whole numbers, ``label`` a column of whole numbers. For each row with
    ``is_anchor`` and each of its ``positives`` best rows of its label: the ``negatives`` best rows of other labels
    whose score is at least ``low`` and at most ``high`` hundredths of the positive's.
    """
    spark = df.sparkSession
    rows = df.select(df[ids].cast("long").alias("id"), F.col(label).cast("long").alias("label"), is_anchor.alias("asked"), components.alias("vector"))
    width = usual_length(rows, "vector")
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") == width) & usable)
    # Zeros have one sign, and the label is a last component: classes agree in it too.
    marked = F.concat(F.transform("vector", lambda x: x + F.lit(0.0)), F.array(F.col("label").cast("double")))
    rows = rows.select("id", "asked", marked.alias("vector"))
    found = classes(rows, positives + 1)
    if not width or not found.take(1):
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    known = found.select("class_id", "ids", F.slice("vector", 1, width).alias("vector"), F.element_at("vector", -1).cast("long").alias("label"))
    placed = written(along_curve(known, width), "placed")
    blocks = written(packed(placed, BLOCK, placed.count(), width, {"ids": "array<long>"}), "blocks")
    members = rows.where("asked").select(F.col("id").alias("anchor_id"), "vector").distinct()
    anchors = written(found.join(members.select("vector").distinct(), "vector").select("class_id", "vector"), "anchors")
    asked = placed.drop("ids").join(anchors.select("class_id"), "class_id", "left_semi")
    whole = anchors.select("class_id", F.lit(0).alias("number"), F.lit(LEAST).alias("low"), F.lit(GREATEST).alias("high"))
    near = _two_rounds(asked, blocks, width, whole, True, positives + 1).select("class_id", "hits")
    scores = near.select("class_id", F.posexplode(F.array_distinct(F.transform("hits", lambda h: -h["order"]))).alias("number", "score"))
    # Hundredths of scores without leaving the range of a long.
    ends = [f"(score div 100) * {low} + ((score % 100) * {low} + 99) div 100 as low", f"(score div 100) * {high} + ((score % 100) * {high}) div 100 as high"]
    scores = written(scores.where("score >= 0").selectExpr("class_id", "number", "score", *ends), "scores")
    far = _two_rounds(asked, blocks, width, scores.drop("score"), False, negatives)
    per_score = F.collect_list(F.struct("score", "hits")).alias("far")
    given = far.join(scores.select("class_id", "number", "score"), ["class_id", "number"]).groupBy("class_id").agg(per_score)
    given = given.join(near, "class_id").join(anchors, "class_id")
    return _told(members, given, positives)


def _told(members: DataFrame, given: DataFrame, positives: int) -> DataFrame:
    """What a class was given, for each of its anchors; equal anchors are dealt over salts."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("anchor_id"), F.lit(SALTS)).cast("int"))
    rows = dealt.join(given.select("*", salts), ["vector", "salt"])
    others = F.filter("hits", lambda h: ~((h["id"] == F.col("anchor_id")) & (h["class_id"] == F.col("class_id"))))
    pairs = rows.select("anchor_id", "far", F.explode(F.slice(others, 1, positives)).alias("p"))
    pairs = pairs.select("anchor_id", "far", F.col("p.id").alias("positive_id"), (-F.col("p.order")).alias("positive_score"))
    window = F.filter("far", lambda f: f["score"] == F.col("positive_score"))
    hits = F.posexplode(F.get(window, F.lit(0))["hits"]).alias("place", "n")
    return pairs.select("anchor_id", "positive_id", "positive_score", hits).select(
        "anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("n.id").alias("negative_id"),
        "positive_score", (-F.col("n.order")).alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row of ``embeddings``, where every seventh label is moved on by one."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", moved)
    return mine(vectors, "vec_id", "label", floors("embedding"), F.col("vec_id") % 50 == 0)


def floors(vector: str) -> Column:
    """floor(256 x) of the components as doubles; what is not finite stays so."""

    def floored(x):
        scaled = x * F.lit(256.0)
        # Doubles from 2^52 on are whole, and a cast to long could cut them.
        return F.when(F.abs(scaled) < F.lit(2.0**52), F.floor(scaled).cast("double")).otherwise(scaled)

    return F.transform(F.col(vector).cast("array<double>"), floored)


ORACLE = """
with v as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select q.vec_id as anchor_id, c.vec_id as id, c.label = q.label as same, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.id)::int as rank,
       s.id as negative_id, positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
qualify rank <= 3"""
