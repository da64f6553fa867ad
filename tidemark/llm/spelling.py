"""Spelling variants: words one edit apart, by dense tiles of common prefixes and suffixes.

Words are counted per task first and summed by Spark. Two words of which the longer has L code points are one
inserted, deleted or replaced code point apart exactly if their common prefix and common suffix together reach
L - 1. One of the two is then at least L // 2 long, so a word is dealt to the groups of its first and of its last
L // 2 code points, once as a word of length L and once as the shorter of a pair. A group of many words is cut
into tiles by the hash of the word, so that a tile holds about ``CELLS`` code points, and every two tiles of a group
meet. A meeting pads both tiles into matrices of code points, compares all rows at once from the left and
from the right, and keeps the pairs whose prefix and suffix are long enough. A pair that meets in both groups
counts in that of the prefix.

A word's form is the near word of the largest count, if that is ``RATIO`` times its own. Counts grow by ``RATIO``
along a chain of forms, so the ends of all chains are found by a few doublings.

Defined results: null and empty texts have no words; a null id stands as an empty text in the occurrence's hash;
rows count as often as they occur; ties between near words go to the smallest in code-point order; an empty
table gives an empty result; other columns are left alone. Words of any length take part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, table, written

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
EVERY = 199
CELLS = 1 << 14
#: Distinct words that a task counts before it hands them on.
FLUSH = 200_000
#: Characters of a text searched at once, and cells compared at once.
SLICE = 1 << 20
STEP = 1 << 21
#: Tiles with fewer pairs are compared pair by pair, many tiles at once.
SMALL = 4_096
#: A count of 64 bits can be multiplied by 5 no more than 27 times, and 2^5 is beyond that.
DOUBLINGS = 5

# The letters of a run after A to Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
_OUTSIDE = re.compile(f"[^{LETTERS}]")


def runs(text: str, least: int):
    """Lists of the maximal runs of ``least`` or more letters, A to Z lower-cased, from a slice of the text each."""
    lowered = text.encode().lower().decode()  # bytes lower-case A to Z alone
    find = re.compile(f"[{LETTERS}]{{{least},}}").findall
    start = 0
    while start < len(lowered):
        cut = _OUTSIDE.search(lowered, start + SLICE)
        end = cut.start() if cut else len(lowered)
        yield find(lowered[start:end])
        start = end


def count_words(df: DataFrame, key: str, text: str, every: int = EVERY, least: int = LEAST_LENGTH) -> DataFrame:
    """(word, n long): the runs of all texts that have ``least`` code points after the deletions.

    Where ``every`` divides the unsigned crc32 h of ``<key>:<run>``, the run's code point h % length is deleted.
    """
    small_batches(df.sparkSession)

    def count(parts):
        total = Counter()
        for batch in parts:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prefix = zlib.crc32(f"{name or ''}:".encode())
                for found in runs(value or "", least):
                    for run, n in Counter(found).items():
                        h = zlib.crc32(run.encode(), prefix)
                        if h % every == 0:
                            h %= len(run)
                            run = run[:h] + run[h + 1 :]
                            if len(run) < least:
                                continue
                        total[run] += n
                    if len(total) > FLUSH:
                        yield _counted(total)
                        total.clear()
        yield _counted(total)

    counted = df.select(F.col(key).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of code points per word, and one of its code points from last to first, padded with 0."""

    def rows(texts):
        # U+0000 pads: words hold letters only.
        joined = "".join(t.ljust(width, "\0") for t in texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        return codes.astype(np.min_scalar_type(int(codes.max(initial=0)))).reshape(len(words), width)

    return rows(words), rows([w[::-1] for w in words])


def dense(left: np.ndarray, right: np.ndarray, known: int) -> np.ndarray:
    """How many columns from the first on are equal, each row of ``left`` with each of ``right``; the first
    ``known`` are known to be."""
    reach = np.full((len(left), len(right)), known, np.min_scalar_type(left.shape[1]))
    alive = np.ones(reach.shape, bool)
    for c in range(known, left.shape[1]):
        alive &= left[:, c, None] == right[None, :, c]
        if not alive.any():
            break
        reach += alive
    return reach


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many columns from the first on are equal, row by row."""
    equal = left == right
    return np.where(equal.all(1), left.shape[1], equal.argmin(1))


class Meetings:
    """Tiles of words that meet in pairs; ``size`` is the length of the longer words."""

    def __init__(self, size: int):
        self.size = size
        self.words: list[str] = []
        self.counts: list[int] = []
        self.large: list[tuple] = []
        self.small: dict[bool, list[tuple]] = {False: [], True: []}

    def tile(self, words: list[str], counts: list[int]) -> tuple[int, int, int]:
        """Where the tile, its shorter words and its end are."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]) < self.size)
        start, longer = len(self.words), sum(len(w) == self.size for w in words)
        self.words += [words[i] for i in order]
        self.counts += [counts[i] for i in order]
        return start, start + longer, start + len(words)

    def meet(self, by_suffix: bool, left: tuple[int, int], right: tuple[int, int]) -> None:
        a, b = left[1] - left[0], right[1] - right[0]
        if not a or not b:
            return
        if a * b >= SMALL:
            self.large.append((by_suffix, left, right))
        else:
            i, j = np.repeat(np.arange(*left), b), np.tile(np.arange(*right), a)
            kept = i < j
            self.small[by_suffix].append((i[kept], j[kept]))

    def pairs(self):
        """(i, j) of the words one edit apart, each pair once."""
        forth, back = matrices(self.words, self.size)
        half, need = self.size // 2, self.size - 1
        for by_suffix, left, right in self.large:
            b = slice(*right)
            rows = max(1, STEP // (right[1] - right[0]))
            for start in range(left[0], left[1], rows):
                a = slice(start, min(left[1], start + rows))
                prefix = dense(forth[a], forth[b], 0 if by_suffix else half)
                suffix = dense(back[a], back[b], half if by_suffix else 0)
                i, j = np.nonzero(self._near(prefix, suffix, need, by_suffix))
                i, j = i + start, j + right[0]
                yield i[i < j], j[i < j]
        for by_suffix, members in self.small.items():
            if members:
                i, j = (np.concatenate(x) for x in zip(*members))
                rows = max(1, STEP // self.size)
                for start in range(0, len(i), rows):
                    a, b = i[start : start + rows], j[start : start + rows]
                    near = self._near(paired(forth[a], forth[b]), paired(back[a], back[b]), need, by_suffix)
                    yield a[near], b[near]

    def _near(self, prefix, suffix, need: int, by_suffix: bool):
        # In a group by suffix, pairs with half a prefix in common are left to the group of that.
        below = self.size // 2 if by_suffix else self.size
        return (prefix < below) & (suffix >= need - np.minimum(prefix, need))


_GROUP = ["size", "by_suffix", "half"]
_LINK = "word string, near string, near_n long"


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) in both directions, from distinct (word, n)."""

    def member(length, half: str, by_suffix: bool):
        part = F.expr(f"right(word, {half})" if by_suffix else f"left(word, {half})")
        longer = length == F.length("word")
        return F.struct(length.alias("size"), F.lit(by_suffix).alias("by_suffix"), part.alias("half"), longer.alias("longer"))

    lengths = ((F.length("word"), "length(word) div 2"), (F.length("word") + 1, "(length(word) + 1) div 2"))
    members = F.array(*[member(length, f"int({half})", side) for length, half in lengths for side in (False, True)])
    dealt = words.select("word", "n", F.explode(members).alias("m")).select("word", "n", "m.*")
    counts = dealt.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("members"), F.max("longer").alias("any"))
    tiles = F.ceil(F.col("members") * F.col("size") / CELLS).cast("int").alias("tiles")
    met = counts.where("members > 1 and any").select(*_GROUP, tiles)
    placed = dealt.join(met, _GROUP).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    row = F.struct("word", "n", "longer")
    held = written(placed.groupBy(*_GROUP, "tiles", "tile").agg(F.collect_list(row).alias("rows")), "tiles")
    other = held.where("tiles > 1").select(*_GROUP, F.col("tile").alias("with"), F.col("rows").alias("others"))
    meeting = F.explode(F.sequence(F.col("tile") + 1, F.col("tiles") - 1)).alias("with")
    pairs = held.where("tile < tiles - 1").select(*_GROUP, "rows", meeting).join(other, [*_GROUP, "with"])
    nothing = F.lit(None).cast(held.schema["rows"].dataType).alias("others")
    every = held.select("size", "by_suffix", "rows", nothing).unionByName(pairs.select("size", "by_suffix", "rows", "others"))
    return every.mapInArrow(_compare, _LINK)


def _compare(parts):
    for batch in parts:
        held, others = batch.column("rows"), batch.column("others")
        groups: dict[int, Meetings] = {}
        cells = 0
        for k, (size, by_suffix) in enumerate(zip(batch.column("size").to_pylist(), batch.column("by_suffix").to_pylist())):
            met = groups.setdefault(size, Meetings(size))
            start, middle, end = met.tile(*_tile(held[k]))
            if others[k].is_valid:
                begin, inside, last = met.tile(*_tile(others[k]))
                met.meet(by_suffix, (start, middle), (begin, last))
                met.meet(by_suffix, (middle, end), (begin, inside))
            else:
                met.meet(by_suffix, (start, middle), (start, middle))
                met.meet(by_suffix, (start, middle), (middle, end))
            cells += size * len(held[k])
            if cells > STEP:
                yield _links(groups)
                groups, cells = {}, 0
        yield _links(groups)


def _tile(rows: pa.ListScalar) -> tuple[list[str], list[int]]:
    return rows.values.field("word").to_pylist(), rows.values.field("n").to_pylist()


def _links(groups: dict[int, Meetings]) -> pa.RecordBatch:
    """Both directions of every pair."""
    word, near, n = [], [], []
    for met in groups.values():
        for i, j in met.pairs():
            for a, b in ((i.tolist(), j.tolist()), (j.tolist(), i.tolist())):
                word += [met.words[x] for x in a]
                near += [met.words[x] for x in b]
                n += [met.counts[x] for x in b]
    arrays = [pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["word", "near", "near_n"])


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) from distinct words and their counts (word, n), read several times."""
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    linked = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    more = -F.col("best.order")
    chosen = (more >= ratio * F.col("n")) & F.col("best").isNotNull()
    formed = words.join(linked, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, more).alias("form_n"),
    )
    formed = written(formed, "forms")
    ends = written(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    for _ in range(DOUBLINGS):
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = ends.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), "beyond")
        step = written(step, "roots")
        ends = step.select("word", "root")
        if not step.where("beyond is not null").take(1):
            break
    found = formed.join(ends, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` with six code points and five occurrences, their near words, forms and roots."""
    words = count_words(table(spark, sf_dir, "documents"), "doc_id", "text")
    return variants(written(words.where(F.col("n") >= LEAST_COUNT), "words"))
