"""Near-duplicates by min-max hashing.

Under each permutation both the minimum and the maximum of a document's shingle hashes are kept, so
``VALUES`` values need half as many permutations. Both match with a probability equal to the Jaccard
similarity. The values are cut into bands; documents that agree in a band meet in a bucket. The rows per
band follow from the similarity asked for: as many as leave a chance of at most ``MISS`` that a pair just
similar enough meets nowhere.

Documents with equal shingle sets form a class and go on as one. A bucket's classes are dealt into blocks
bounded in number and in shingles. Within a block, every pair is confirmed on full sets; only as many links
as hold its groups together leave the task. Then the components so far are formed. Where a bucket has more
than one block, members outside its largest component are compared with all members of other components,
block by block: links inside a component need no proof, so a very large group of copies costs little, and
no link between components is lost.

Defined results: texts that are null or without words have an empty set and are linked with nothing; fewer
words than a shingle make one shingle of them all; repeated rows are equal documents; other columns are
carried along where rows are returned. Rows without an id (null) are linked like others, but a component's
id is its least id that is not null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, table, with_row_id, written
from tidemark.llm.components import components
from tidemark.llm.hashing import Powers, mixed, shingles

VALUES = 126
MISS = 1e-4
BLOCK_MEMBERS = 1_024
BLOCK_SHINGLES = 1 << 21


def rows_per_band(similarity: float, values: int = VALUES, miss: float = MISS) -> int:
    fitting = [r for r in range(1, values + 1) if (1 - similarity**r) ** (values // r) <= miss]
    return max(fitting, default=1)


class Signer:
    """Min-max signatures, cut into bands."""

    def __init__(self, similarity: float, values: int = VALUES):
        random = np.random.default_rng(7)
        self.factors = random.integers(0, 2**64, values // 2, dtype=np.uint64) | np.uint64(1)
        self.terms = random.integers(0, 2**64, values // 2, dtype=np.uint64)
        self.rows = rows_per_band(similarity, values)
        self.bands = values // self.rows

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of minima and maxima per set; no set may be empty."""
        flat = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        out = np.empty((len(sets), 2 * len(self.factors)), np.uint64)
        for i, (factor, term) in enumerate(zip(self.factors, self.terms)):
            hashed = flat * factor + term
            hashed ^= hashed >> np.uint64(29)
            out[:, 2 * i] = np.minimum.reduceat(hashed, starts)
            out[:, 2 * i + 1] = np.maximum.reduceat(hashed, starts)
        return out

    def band_keys(self, sets: list[np.ndarray]) -> np.ndarray:
        signatures = self.signatures(sets)
        keys = np.tile(np.arange(self.bands, dtype=np.uint64), (len(sets), 1))
        for r in range(self.rows):
            keys = mixed(keys * np.uint64(0x9FB21C651E98DF25) + signatures[:, r : self.bands * self.rows : self.rows])
        return keys.view(np.int64)


def sign(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(row_id, n_shingles, digest, bands) from (row_id, text); digest is null for empty sets."""
    small_batches(docs.sparkSession)

    def batches(parts):
        signer, known = Signer(similarity), Powers()
        for batch in parts:
            sets = [shingles((t or "").encode(), words, known) for t in batch.column(1).to_pylist()]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            bands: list = [None] * len(sets)
            filled = [i for i, s in enumerate(sets) if len(s)]
            start = 0
            while start < len(filled):
                end, size = start, 0
                while end < len(filled) and size < 1 << 18:
                    size += len(sets[filled[end]])
                    end += 1
                for i, keys in zip(filled[start:end], signer.band_keys([sets[i] for i in filled[start:end]])):
                    bands[i] = keys
                start = end
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row_id", "n_shingles", "digest", "bands"])

    kind = docs.schema["row_id"].dataType.simpleString()
    return docs.select("row_id", "text").mapInArrow(batches, f"row_id {kind}, n_shingles long, digest binary, bands array<long>")


def shared_counts(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all ``sets`` with each other, or with ``others``."""
    every = sets + (others or [])
    names, place = np.unique(np.concatenate(every), return_inverse=True)
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    # Shingles in one set only add nothing; the others get columns, a slab of them at a time.
    common = np.bincount(place)[place] > 1
    place, owner = place[common], owner[common]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    new = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    rows, width = len(sets), 4096
    first = slice(0, rows)
    second = slice(rows, None) if others else slice(0, rows)
    total = np.zeros((rows, len(every) - rows if others else rows), np.float64)
    bounds = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + width + 1, width))
    for slab, (a, b) in enumerate(zip(bounds, bounds[1:])):
        held = np.zeros((len(every), width), np.float32)
        held[owner[a:b], column[a:b] - slab * width] = 1
        total += held[first] @ held[second].T
    return total


def linked(sets: list[np.ndarray], percent: int, others: list[np.ndarray] | None = None) -> np.ndarray:
    shared = shared_counts(sets, others)
    sizes = np.array([len(s) for s in sets])
    union = sizes[:, None] + np.array([len(s) for s in (others or sets)])[None, :] - shared
    return 100 * shared >= percent * union


def spanning(links: np.ndarray) -> list[tuple[int, int]]:
    """(first, member) pairs that hold the components of a boolean matrix together."""
    label = np.arange(len(links))
    while True:
        least = np.where(links, label[None, :], len(links)).min(1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return [(int(a), i) for i, a in enumerate(label) if a != i]
        label = new


_MEMBER = "group long, part int, digest binary, label binary, text string"


def _streamed(parts, confirm):
    """Rows of a sorted partition, group by group, through ``confirm``; links as Arrow batches."""

    def answer(group):
        pairs = confirm(group)
        if pairs:
            a, b = zip(*pairs)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    group, current = [], None
    for batch in parts:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != current:
                yield from answer(group)
                group, current = [], row[0]
            group.append(row[1:])
    yield from answer(group)


def confirm_within(members: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) among the members (group, digest, text) of each group."""

    def run(parts):
        def confirm(group):
            if len(group) < 2:
                return []
            links = linked([shingles(text.encode(), words) for _, text in group], percent)
            return [(group[a][0], group[b][0]) for a, b in spanning(links)]

        return _streamed(parts, confirm)

    return members.select("group", "digest", "text").mapInArrow(run, "a binary, b binary")


def confirm_between(members: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between parts 0 and 1 of each group, of members with different labels."""

    def run(parts):
        def confirm(group):
            sides = [[r for r in group if r[0] == side] for side in (0, 1)]
            if not all(sides):
                return []
            left, right = ([shingles(r[3].encode(), words) for r in side] for side in sides)
            found = linked(left, percent, right)
            labels = [np.array([r[2] for r in side], object) for side in sides]
            found &= labels[0][:, None] != labels[1][None, :]
            # One link from each member to each other component is enough.
            pairs = {(a, labels[1][b]): b for a, b in zip(*np.nonzero(found))}
            return [(sides[0][a][1], sides[1][b][1]) for (a, _), b in pairs.items()]

        return _streamed(parts, confirm)

    return members.select("group", "part", "digest", "label", "text").mapInArrow(run, "a binary, b binary")


def by_group(members: DataFrame) -> DataFrame:
    """Members of a group side by side in one task; the number of tasks is the session's."""
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(tasks, "group").sortWithinPartitions("group", "digest")


def links_between_classes(classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that join all near-duplicate classes, from (digest, n_shingles, bands) and (digest, text)."""
    seats = classes.select("digest", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = seats.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("weight")).where("members > 1")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_MEMBERS, F.col("weight") / BLOCK_SHINGLES)).cast("int")
    seats = seats.join(sizes.select("bucket", blocks.alias("blocks")), "bucket")
    block = F.pmod(F.xxhash64("digest", "bucket"), F.col("blocks")).cast("int")
    seats = written(seats.select("bucket", "blocks", block.alias("block"), "digest", "n_shingles"), "seats")
    # Buckets of several bands often hold the same classes; one of them is enough.
    same = seats.groupBy("bucket", "block").agg(
        F.count("*").alias("members"), F.first("blocks").alias("blocks"),
        F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("xor"),
    )
    once = same.where("members > 1").groupBy("members", "sum", "xor").agg(F.min(F.struct("bucket", "block")).alias("kept"))
    groups = once.select("kept.*", F.xxhash64("kept.bucket", "kept.block").alias("group"))
    placed = seats.join(groups, ["bucket", "block"]).select("group", "digest")
    first = written(confirm_within(by_group(placed.join(texts, "digest")), words, percent), "confirmed")

    large = seats.where("blocks > 1")
    if not large.take(1):
        return first
    roots = components(first).select(F.col("node").alias("digest"), F.col("root").alias("label"))
    labelled = large.join(roots, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    counts = labelled.groupBy("bucket", "label").count()
    top = counts.groupBy("bucket").agg(F.max_by("label", F.struct("count", "label")).alias("top"))
    labelled = written(labelled.join(top, "bucket"), "labelled")
    fringe = labelled.where("label <> top")
    fringe_sizes = fringe.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("weight"))
    fringe_blocks = fringe_sizes.select("bucket", blocks.alias("fringe_blocks"))
    both = labelled.join(fringe_blocks, "bucket")
    # Every block of the fringe meets every block of its bucket.
    of_fringe = F.pmod(F.xxhash64("digest", "bucket", F.lit(1)), F.col("fringe_blocks")).cast("int")
    asking = both.where("label <> top").select(
        "bucket", of_fringe.alias("f"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), F.lit(0).alias("part"), "digest", "label"
    )
    asked = both.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("fringe_blocks") - 1)).alias("f"), F.col("block").alias("b"), F.lit(1).alias("part"), "digest", "label"
    )
    seated = asking.unionByName(asked).withColumn("group", F.xxhash64("bucket", "f", "b"))
    second = confirm_between(by_group(seated.join(texts, "digest")), words, percent)
    return written(first.union(second), "confirmed")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(row_id, n_shingles, component_id, first_row) per row of ``docs`` (row_id unique, doc_id, text).

    ``component_id`` is the least id of the rows that links reach; ``first_row`` is one row with it. Both
    are the row's own for rows with an empty set.
    """
    signed = written(sign(docs, words, percent / 100), "signed")
    ids = signed.join(docs.select("row_id", "doc_id"), "row_id").select("row_id", "doc_id", "n_shingles", "digest")
    # Nulls last: a null id never names a component that has another.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")
    firsts = ids.where("digest is not null").groupBy("digest").agg(F.min(order).alias("first"), F.first("n_shingles").alias("n_shingles"))
    firsts = written(firsts, "firsts")
    keyed = firsts.select("digest", F.col("first.row_id").alias("row_id"), "n_shingles")
    classes = keyed.join(signed.select("row_id", "bands"), "row_id").select("digest", "row_id", "n_shingles", "bands")
    meeting = written(_meeting(classes), "classes")
    texts = written(docs.select("row_id", "text").join(meeting.select("row_id", "digest"), "row_id").select("digest", "text"), "texts")
    roots = components(links_between_classes(meeting, texts, words, percent))
    rooted = firsts.join(roots, firsts["digest"] == roots["node"], "left")
    rooted = rooted.select("digest", "first", F.coalesce("root", "digest").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(least, "root").select("digest", "least")
    joined = ids.join(named, "digest", "left")
    return joined.select(
        "row_id", "doc_id", "n_shingles",
        F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        F.coalesce("least.row_id", "row_id").alias("first_row"),
    )


def _meeting(classes: DataFrame) -> DataFrame:
    """The classes that share a bucket with another class."""
    seats = classes.select("digest", F.explode("bands").alias("bucket"))
    shared = seats.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    meet = seats.join(shared, "bucket", "left_semi").select("digest").distinct()
    return classes.join(meet, "digest", "left_semi")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles agree by 85 percent."""
    docs = written(with_row_id(table(spark, sf_dir, "documents").select("doc_id", "text")), "documents")
    found = near_duplicates(docs, words=3, percent=85)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
