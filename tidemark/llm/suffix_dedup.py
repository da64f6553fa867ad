"""Removal of repeated byte strings by grouping the hashes of phrase runs that shards have sorted.

No Burrows-Wheeler transform is made or merged: hash grouping of phrase runs stands in its place.

**Symbols.** A text is cut where content says so: of every window of ``WINDOW`` k-grams the leftmost one with
the least hash is a cut. A phrase runs from one cut to the next; its name is a hash of its bytes and of the
k-gram that follows, in 64 bits. Equal strings of ``length`` bytes have the same cuts inside, and at least one
whole phrase. Names are the symbols that are sorted, which are some 45 times fewer than the bytes.

**Shards.** Texts go into shards of about ``SHARD_BYTES`` bytes, one row each. A shard sorts its suffixes once
and keeps the order and the common prefixes of neighbours; the symbol before a suffix is neither kept nor read.
No suffix is sorted again.

**Grouping.** A block is the suffixes that agree in their first symbols, and is one run of rows in each shard. A
round hashes the first 1, 4, 16 ... names of every run that is still shared anew, from the names and not from the
round before, and groups equal hashes over all shards; blocks with a single row are settled and drop out. A shard
sends one row per run, never its suffixes, and gets back which of its runs are repeated. Rounds end when all
blocks reach over ``length`` bytes: the common prefix of a block is then long enough, and its rows are repeated
intervals. Names of one symbol only tell what can be dropped. Blocks agree in 128 bits over their names, so no
further than the 64 bits of each name; windows compared one by one (below) agree in 128 bits over their bytes.

**Edges.** A repeat may begin and end inside phrases. Windows of ``length`` bytes that hold bytes not yet
covered, and whose whole phrases are all repeated, are compared byte for byte by 128-bit hashes: in groups of
``GROUP`` windows at a time (equal groups are settled at once, groups whose common part is unique drop out),
then one by one.

Work on a shard sees one shard only. What comes back is a list of row numbers per shard, joined to the table
of shards, which is bucketed by shard and is not shuffled again.

Defined results: a null text is an empty one; texts shorter than ``length`` keep all bytes; repeated rows are
copies of each other, so all their bytes go; columns other than the text are carried along in a struct.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, table, written
from tidemark.llm.hashing import Powers, Ranges, byte_numbers, mixed
from tidemark.workspace import scratch_path

LENGTH = 200
KGRAM = 12
SHARD_BYTES = 4 << 20
PARSE_BYTES = 1 << 19
GROUP = 32
WIDEN = 4

_FIRST, _SECOND = byte_numbers(11), byte_numbers(12)


def window_of(length: int) -> int:
    """K-grams per window, such that a string of ``length`` bytes holds two different cuts."""
    return (length - KGRAM) // 2


class Parsed:
    """Cuts and phrases of texts that stand one after the other, each followed by one separator.

    ``bound`` has the cuts, starts and ends of the texts of ``length`` bytes or more, in order; ``is_end``
    tells the ends. ``name`` is the name of the phrase that begins at a bound, 0 at ends. The windows whose
    cut is a bound begin at ``low`` and are ``count``.
    """

    def __init__(self, texts: list[bytes], length: int, known: Powers | None = None):
        found, base = [], 0
        known = known or Powers()
        for part in in_parts(texts):
            raw = np.frombuffer(b"\0".join(part) + b"\0", np.uint8)
            bound, is_end, name, low, count = parse(raw, np.array([len(t) for t in part]), length, known)
            found.append((bound + base, is_end, name, low + base, count))
            base += len(raw)
        empty = np.zeros(0, np.int64)
        columns = [np.concatenate(c) for c in zip(*found)] if found else [empty, empty.astype(bool), empty.astype(np.uint64), empty, empty]
        self.bound, self.is_end, self.name, self.low, self.count = columns


def in_parts(texts: list[bytes]):
    """Runs of whole texts of about ``PARSE_BYTES``."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= PARSE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def parse(raw: np.ndarray, sizes: np.ndarray, length: int, known: Powers):
    window = window_of(length)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    long = sizes >= length
    starts, ends = starts[long], ends[long]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none.astype(bool), none.astype(np.uint64), none, none
    ranges = Ranges(_FIRST[raw], known)
    grams = mixed((ranges.sums[KGRAM:] - ranges.sums[:-KGRAM]) * ranges.back[: len(raw) - KGRAM + 1])
    # The hash above, the place below: the least is the leftmost of the least.
    least = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(least) - (window - span)], least[window - span :])
    # Windows that lie within one of the texts.
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[starts] += 1
    inside[ends - (window + KGRAM - 1) + 1] -= 1
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    cut = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], cut[1:] != cut[:-1]]))
    bound = np.unique(np.concatenate([starts, cut[first], ends]))
    low, count = np.zeros((2, len(bound)), np.int64)
    index = np.searchsorted(bound, cut[first])
    low[index], count[index] = at[first], np.diff(np.concatenate([first, [len(at)]]))
    is_end = np.zeros(len(bound), bool)
    is_end[np.searchsorted(bound, ends)] = True
    begin = np.flatnonzero(~is_end)
    stop = ends[np.searchsorted(ends, bound[begin], side="right")]
    name = np.zeros(len(bound), np.uint64)
    size = (bound[begin + 1] - bound[begin]).astype(np.uint64)
    # The size tells a last phrase, which has no k-gram after it, from one that has.
    name[begin] = mixed(ranges.of(bound[begin], np.minimum(bound[begin + 1] + KGRAM, stop)) + size)
    return bound, is_end, name, low, count


def suffix_order(name: np.ndarray, is_end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the suffixes that begin at phrases, sorted by their first ``depth`` symbols, and the number of
    symbols that each shares with the row before it. Symbols are ordered by name, in every shard alike."""
    n = len(name)
    _, rank = np.unique(name, return_inverse=True)
    ranks, span = [rank], 1
    while span < depth:
        after = np.concatenate([rank[span:], np.zeros(min(span, n), rank.dtype)])[:n]
        _, rank = np.unique(rank * np.int64(n + 1) + after, return_inverse=True)
        ranks.append(rank)
        span *= 2
    order = np.argsort(rank, kind="stable")
    order = order[~is_end[order]]
    shared = np.zeros(len(order), np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        padded = np.concatenate([ranks[level], [-1]])
        same = padded[np.minimum(a, n)] == padded[np.minimum(b, n)]
        same &= (a < n) & (b < n)
        step = np.where(same, 1 << level, 0)
        shared[1:] += step
        a, b = a + step, b + step
    return order, shared


class Shard:
    """The transform of one shard, and what the rounds have told about it so far."""

    def __init__(self, bound, is_end, name, order, shared, length: int):
        self.bound, self.is_end, self.name, self.length = bound, is_end, name, length
        self.order, self.shared = order, shared
        n = len(bound)
        at_end = np.flatnonzero(is_end)
        # Phrases that a suffix needs to reach over ``length`` bytes, 0 if its text ends before.
        stop = bound[at_end[np.searchsorted(at_end, np.arange(n))]] if n else bound
        reach = np.minimum(np.searchsorted(bound, bound + length - KGRAM), max(0, n - 1))
        self.until = np.minimum(bound[reach] + KGRAM, stop) if n else bound
        self.need = np.where((stop - bound >= length) & ~is_end, reach - np.arange(n), 0)
        # Running sums of names times powers: the name of any run of symbols.
        raw = name.astype(np.uint64)
        known = Powers()
        self.sums = [Ranges(mixed(raw + np.uint64(salt)), known) for salt in (1, 2)]
        self.alive = np.zeros(n, bool)
        self.dead = np.zeros(n + 1, np.int64)
        self.repeated = np.zeros(n, bool)
        self.found: list[np.ndarray] = []

    @property
    def covered(self) -> tuple[np.ndarray, np.ndarray]:
        """The intervals that repeated blocks cover."""
        return merged(*(np.concatenate(self.found, 1) if self.found else np.zeros((2, 0), np.int64)))

    def rows(self, depth: int) -> np.ndarray:
        """The rows that a round to ``depth`` symbols refines."""
        if depth == 1:
            return np.arange(len(self.order))
        at = self.order
        size = np.minimum(self.need[at], depth)
        known = self.dead[at + size] == self.dead[at]
        fresh = self.need[at] > 0 if depth == WIDEN else self.repeated[at] & (self.need[at] > depth // WIDEN)
        return np.flatnonzero(known & fresh)

    def runs(self, depth: int):
        """(rows, number of the run of each, first row of each run) at ``depth`` symbols."""
        rows = self.rows(depth)
        size = np.ones(len(rows), np.int64) if depth == 1 else np.minimum(self.need[self.order[rows]], depth)
        new = self.shared[rows] < size
        if len(rows):
            new[0] = True
        return rows, np.cumsum(new) - 1, rows[new], size[new]

    def blocks(self, depth: int):
        """One row per run: (at, rows, whether it needs more symbols, two halves of the block's name)."""
        rows, run, first, size = self.runs(depth)
        at = self.order[first]
        return first, np.bincount(run, minlength=len(first)), self.need[at] > depth, *(s.of(at, at + size) for s in self.sums)

    def told(self, depth: int, repeated: np.ndarray) -> None:
        """Takes in which runs of a round are repeated, by their first rows."""
        rows, run, first, _ = self.runs(depth)
        at = self.order[rows[np.isin(first, repeated)[run]]]
        if depth == 1:
            self.alive[at] = True
            self.dead = np.concatenate([[0], np.cumsum(~self.alive)])
            return
        self.repeated[:] = False
        self.repeated[at] = True
        done = at[self.need[at] <= depth]
        if len(done):
            self.found.append(np.stack([self.bound[done], self.until[done]]))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals that a set of intervals covers, in order; those that touch are one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([new[1:], [True]])]


def spread(low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of ranges that begin at ``low`` and hold ``count``, and the range of each."""
    of = np.repeat(np.arange(len(low)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + low[of], of


def classed(*keys: np.ndarray):
    """(first of each class, class of each, rows of each class) of rows that agree in all ``keys``."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    same = np.empty(len(order), np.int64)
    same[order] = np.cumsum(new) - 1
    return order[new], same, np.diff(np.concatenate([np.flatnonzero(new), [len(order)]]))


def open_runs(shard: Shard, low: np.ndarray, count: np.ndarray):
    """Groups of windows that share their whole phrases, where these are all repeated.

    A group is a cut and the last cut within the windows; its windows begin side by side. Gives the cut,
    first place and number of windows of each group, its class by the name of its phrases, and per class whether one of its windows holds a byte that is not covered yet.
    """
    last = shard.length - (window_of(shard.length) + KGRAM - 1)
    cuts = np.flatnonzero((count > 0) & shard.alive)
    place, of = spread(low[cuts], count[cuts])
    every = np.flatnonzero(count > 0)
    # The window that begins ``last`` later, and its cut; none if the text ends before.
    index = np.searchsorted(low[every], place + last, side="right") - 1
    after = every[index]
    j = cuts[of]
    fits = (place + last < low[after] + count[after]) & (shard.dead[np.maximum(after, j)] == shard.dead[j])
    place, j, after = place[fits], j[fits], after[fits]
    starts, ends = shard.covered
    known = np.searchsorted(starts, place, side="right") - 1
    covered = (known >= 0) & (ends[np.maximum(known, 0)] >= place + shard.length) if len(starts) else np.zeros(len(place), bool)
    new = np.zeros(len(place), bool)
    new[:1] = True
    new[1:] = (j[1:] != j[:-1]) | (after[1:] != after[:-1])
    first = np.flatnonzero(new)
    windows = np.diff(np.concatenate([first, [len(place)]]))
    named = shard.sums[0].of(j[first], after[first])
    chosen, same, groups = classed(named)
    asks = np.zeros(len(chosen), bool)
    asks[same[np.cumsum(new)[~covered] - 1]] = True
    return j[first], place[first], windows, same, named[chosen], groups, asks


def nodes_of(bound: np.ndarray, low: np.ndarray, count: np.ndarray):
    """Windows of groups, and the groups of ``GROUP`` windows at like distances from their cut.

    Gives places, node of each, and per node its cut's place and its distance in steps. Groups of one cut
    are given side by side; ``bound`` is the place of a group's cut.
    """
    place, of = spread(low, count)
    cut = bound[of]
    step = (cut - place) // GROUP
    # Distances shrink along the windows of a cut, so a node's windows are neighbours.
    new = np.zeros(len(place), bool)
    new[:1] = True
    new[1:] = (cut[1:] != cut[:-1]) | (step[1:] != step[:-1])
    return place, np.cumsum(new) - 1, cut[new], step[new]


class Bytes:
    """128-bit hashes of byte ranges of a shard's texts, part by part."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.stops = self.starts + sizes - 1
        self.parts = [b"\0".join(part) + b"\0" for part in in_parts(texts)]
        self.bases = np.cumsum([0] + [len(p) for p in self.parts])
        self.known = Powers()

    def text(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and stop of the texts that hold ``place``."""
        index = np.searchsorted(self.starts, place, side="right") - 1
        return self.starts[index], self.stops[index]

    def hashes(self, *ranges: tuple[np.ndarray, np.ndarray], halves=None) -> list[np.ndarray]:
        """For each of several arrays of ranges, all within texts, its ``halves``: both unless told."""
        halves = halves or [(_FIRST, _SECOND)] * len(ranges)
        out = [np.zeros((len(h), len(start)), np.uint64) for h, (start, _) in zip(halves, ranges)]
        places = []
        for start, _ in ranges:
            part = np.searchsorted(self.bases, start, side="right") - 1
            order = np.argsort(part, kind="stable")
            places.append((order, np.searchsorted(part[order], np.arange(len(self.parts) + 1))))
        for number, part in enumerate(self.parts):
            rows = [order[cuts[number] : cuts[number + 1]] for order, cuts in places]
            if any(len(r) for r in rows):
                raw, base = np.frombuffer(part, np.uint8), self.bases[number]
                for numbers in (_FIRST, _SECOND):
                    hashed = None
                    for found, own, r, (start, end) in zip(out, halves, rows, ranges):
                        for half, wanted in enumerate(own):
                            if wanted is numbers and len(r):
                                hashed = hashed or Ranges(numbers[raw], self.known)
                                found[half, r] = hashed.of(start[r] - base, end[r] - base)
        return out


def node_hashes(raw: Bytes, cut: np.ndarray, step: np.ndarray, length: int):
    """Per node a hash of what all its windows hold, with their distance, and one of all they hold together.

    The two hashes are independent, so nodes that agree in both agree in 128 bits. Where the windows of a
    whole node would reach beyond the text, the second hash is like no other.
    """
    high = cut - step * GROUP
    low = high - GROUP + 1
    start, stop = raw.text(cut)
    fits = (low >= start) & (high + length <= stop)
    core, every = raw.hashes((high, low + length), (low[fits], high[fits] + length), halves=((_FIRST,), (_SECOND,)))
    whole = np.arange(len(cut)).astype(np.uint64)
    whole[fits] = every[0]
    return mixed(core[0] + step.astype(np.uint64)), whole, fits


def shards(df: DataFrame, text: str, length: int) -> DataFrame:
    """A bucketed table, a row per shard: its texts, the other columns of their rows, and its transform."""
    spark = df.sparkSession
    small_batches(spark)
    others = [c for c in df.columns if c != text]
    rows = df.select(F.struct(*[df[c] for c in others]).alias("row"), df[text].cast("string").alias("text"))

    def build(parts):
        from pyspark import TaskContext

        shard, known = TaskContext.get().partitionId() << 32, Powers()
        held, texts, size = [], [], 0
        for batch in parts:
            start = 0
            for i, t in enumerate(batch.column(1).to_pylist()):
                texts.append((t or "").encode())
                size += len(texts[-1])
                if size >= SHARD_BYTES:
                    held.append(batch.column(0).slice(start, i + 1 - start))
                    yield row(shard, held, texts, known)
                    shard, held, texts, size, start = shard + 1, [], [], 0, i + 1
            if start < len(batch):
                held.append(batch.column(0).slice(start))
        if texts:
            yield row(shard, held, texts, known)

    def row(shard, held, texts, known):
        parsed = Parsed(texts, length, known)
        order, common = suffix_order(parsed.name, parsed.is_end, length)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int64()),
                _listed(pa.concat_arrays(held)),
                _listed(pa.array(texts, pa.binary())),
                *(_listed(pa.array(x, pa.int32())) for x in (parsed.bound, np.flatnonzero(parsed.is_end), order, np.minimum(common, length))),
                _listed(pa.array(parsed.name.view(np.int64))),
                *(_listed(pa.array(x, pa.int32())) for x in (parsed.low, parsed.count)),
            ],
            names=["shard", "rows", "texts", "bound", "ends", "order", "shared", "name", "low", "count"],
        )

    kinds = rows.schema["row"].dataType.simpleString()
    shape = f"shard long, rows array<{kinds}>, texts array<binary>, bound array<int>, ends array<int>, order array<int>, shared array<int>, name array<long>, low array<int>, count array<int>"
    built = rows.mapInArrow(build, shape)
    name = f"shards_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "shards")
    built.write.bucketBy(buckets, "shard").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def _listed(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


_STATE = ["shard", "bound", "ends", "order", "shared", "name"]


def _joined(base: DataFrame, told: list, columns: list[str]) -> DataFrame:
    """Shards with the lists that belong to them."""
    out = base.select(*columns)
    for lists in told:
        out = out.join(lists.hint("shuffle_hash"), "shard", "left")
    return out


def _numpy(scalar, kind=np.int64) -> np.ndarray:
    return np.zeros(0, kind) if scalar is None or scalar.values is None else scalar.values.to_numpy(zero_copy_only=False).astype(kind)


def _restored(row: dict, depths: list[int], length: int) -> Shard:
    bound, ends = _numpy(row["bound"]), _numpy(row["ends"])
    is_end = np.zeros(len(bound), bool)
    is_end[ends] = True
    shard = Shard(bound, is_end, _numpy(row["name"]).view(np.uint64), _numpy(row["order"]), _numpy(row["shared"]), length)
    for depth in depths:
        shard.told(depth, _numpy(row[f"depth_{depth}"]))
    return shard


def _over(frame: DataFrame, work, sent: str, kept: str = "") -> DataFrame:
    """``work`` on each shard. It gives numpy columns to send, a row per class, and arrays of integers to keep
    with the shard, which form one more row; either may be None."""
    columns = [c.split() for c in sent.split(", ")]
    lists = kept.split(", ") if kept else []
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [pa.field("shard", pa.int64()), *(pa.field(n, types[t]) for n, t in columns), *(pa.field(n, pa.list_(pa.int32())) for n in lists)]

    def run(parts):
        for batch in parts:
            for i in range(len(batch)):
                row = {c: batch.column(k)[i] for k, c in enumerate(batch.schema.names)}
                values, keep = work(row)
                if values is not None and len(values[0]):
                    size = len(values[0])
                    arrays = [pa.array(np.full(size, row["shard"].as_py())), *(pa.array(v, f.type) for v, f in zip(values, fields[1:]))]
                    arrays += [pa.nulls(size, f.type) for f in fields[len(arrays) :]]
                    yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))
                if keep is not None:
                    arrays = [pa.array([row["shard"].as_py()]), *(pa.nulls(1, f.type) for f in fields[1 : 1 + len(columns)])]
                    arrays += [_listed(pa.array(k, pa.int32())) for k in keep]
                    yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    shape = ", ".join(["shard long", sent, *(f"{n} array<int>" for n in lists)])
    return frame.mapInArrow(run, shape)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _met(sent: DataFrame, names: list[str], *more) -> DataFrame:
    """Classes of equal names over all shards: ``n``, what ``more`` says, and where (shard, at) they are.

    A shard sends a class once, so there is nothing to combine before the shuffle, and a name has no more
    rows than there are shards.
    """
    tasks = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = F.collect_list(F.struct("shard", "at")).alias("places")
    return sent.repartition(tasks, *names).groupBy(*names).agg(F.sum("n").alias("n"), *more, places)


def _back(chosen: DataFrame, name: str, *more: str) -> DataFrame:
    """Lists of classes per shard, from (places: array of (shard, at)), and the maxima of ``more``."""
    places = chosen.select(F.explode("places").alias("place"), *more).select("place.shard", "place.at", *more)
    sums = [F.max(m).alias(m) for m in more]
    return written(places.groupBy("shard").agg(F.collect_list("at").alias(name), *sums), name)


def repeated_blocks(base: DataFrame, length: int) -> tuple[list, list[int]]:
    """The rounds: lists per depth, and the depths 1, 4, 16 and so on."""
    told, depths, depth = [], [], 1
    while True:

        def work(row, depth=depth, depths=tuple(depths)):
            at, count, more, first, second = _restored(row, list(depths), length).blocks(depth)
            # One symbol never covers anything by itself; half a name is enough to drop what is unique.
            return (at, count, more, _signed(first), *([_signed(second)] if depth > 1 else [])), None

        names = ["first", "second"] if depth > 1 else ["first"]
        sent = _over(_joined(base, told, _STATE), work, ", ".join(["at int, n int, more boolean", *(f"{n} long" for n in names)]))
        blocks = _met(sent, names, F.max("more").alias("more")).where("n > 1")
        lists = _back(blocks, f"depth_{depth}", "more")
        told.append(lists.drop("more"))
        depths.append(depth)
        # A suffix goes on while its block is shared and does not reach far enough.
        if depth > 1 and not lists.where("more").take(1):
            return told, depths
        depth *= WIDEN


def remove_repeats(df: DataFrame, text: str = "text", length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """(row, kept, n_bytes, n_removed, n_spans) per row of ``df``.

    ``row`` holds the columns other than ``text``; ``kept`` the bytes not covered by any string of ``length``
    bytes that starts at two places. With ``as_text`` they are text, without the rests of characters that
    were removed in part.
    """
    base = shards(df, text, length)
    told, depths = repeated_blocks(base, length)

    def ask(row):
        shard = _restored(row, depths, length)
        starts, ends = shard.covered
        if not shard.alive.any():
            return None, (starts, ends, *np.zeros((4, 0), np.int64))
        cut, place, windows, same, named, groups, asks = open_runs(shard, _numpy(row["low"]), _numpy(row["count"]))
        return (np.arange(len(groups)), groups, asks, _signed(named)), (starts, ends, shard.bound[cut], place, windows, same)

    kept = "starts, ends, cut, place, windows, same"
    found = written(_over(_joined(base, told, [*_STATE, "low", "count"]), ask, "at int, n int, asks boolean, name long", kept), "runs")
    runs = _met(found.where("at is not null").select("shard", "at", "n", "asks", "name"), ["name"], F.max("asks").alias("asks"))
    asked = _back(runs.where("n > 1 and asks"), "asked")
    state = found.where("at is null").select("shard", "starts", "ends", "cut", "place", "windows", "same")

    def nodes(row):
        """Windows and their nodes, and the nodes' classes: (first node, class of each, nodes), and their hashes."""
        chosen = np.isin(_numpy(row["same"]), _numpy(row["asked"]))
        place, node, cut, step = nodes_of(_numpy(row["cut"])[chosen], _numpy(row["place"])[chosen], _numpy(row["windows"])[chosen])
        raw = Bytes(row["texts"].values.to_pylist())
        core, whole, fits = node_hashes(raw, cut, step, length)
        return raw, place, node, classed(core, whole, fits), core, whole, fits

    def groups(row):
        if not len(_numpy(row["asked"])):
            return None, None
        _, _, _, (first, _, count), core, whole, fits = nodes(row)
        # Beyond the text's ends nothing is equal: such a node is named by its shard as well.
        place = np.uint64(row["shard"].as_py() * 0x9E3779B97F4A7C15 % 2**64)
        own = np.where(fits, whole, mixed(whole + place))
        return (np.arange(len(first)), count, _signed(core[first]), _signed(own[first]), fits[first]), None

    sent = _over(_joined(base, [state, asked], ["shard", "texts"]), groups, "at int, n int, core long, every long, fits boolean")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sent.repartition(tasks, "core")
    shared = dealt.groupBy("core").agg(F.sum("n").alias("total")).where("total > 1").select("core")
    equal = dealt.join(shared, "core", "left_semi").groupBy("core", "every", "fits")
    places = F.collect_list(F.struct("shard", "at")).alias("places")
    equal = equal.agg(F.sum("n").alias("n"), places).withColumn("settled", F.col("fits") & (F.col("n") > 1))
    equal = written(equal, "groups")
    done = equal.groupBy("core").agg(F.bool_and("settled").alias("done")).where("not done").select("core")
    # A settled group has to show its windows to the others once only.
    one = F.when(F.col("settled"), F.array(F.array_min("places"))).otherwise(F.col("places"))
    settled = _back(equal.where("settled"), "settled")
    unclear = _back(equal.join(done, "core", "left_semi").withColumn("places", one), "unclear")

    def windows(row):
        if not len(_numpy(row["unclear"])):
            return None, None
        raw, place, node, (first, _, _), _, _, _ = nodes(row)
        place = place[np.isin(node, first[_numpy(row["unclear"])])]
        (halves,) = raw.hashes((place, place + length))
        first, same, count = classed(*halves)
        return (np.arange(len(first)), count, *(_signed(h[first]) for h in halves)), (place, same)

    frame = _joined(base, [state, asked, unclear], ["shard", "texts"])
    found = written(_over(frame, windows, "at int, n int, first long, second long", "at_place, window_class"), "windows")
    of_windows = found.where("at is null").select("shard", "at_place", "window_class")
    equal = _met(found.where("at is not null").select("shard", "at", "n", "first", "second"), ["first", "second"])
    repeated = _back(equal.where("n > 1"), "repeated")
    final = _joined(base, [state, asked, settled, of_windows, repeated], ["shard", "rows", "texts"])

    def covered(row) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = [_numpy(row["starts"])], [_numpy(row["ends"])]
        if len(_numpy(row["settled"])):
            _, place, node, (_, same, _), _, _, _ = nodes(row)
            place = place[np.isin(same, _numpy(row["settled"]))[node]]
            starts.append(place)
            ends.append(place + length)
        place = _numpy(row["at_place"])[np.isin(_numpy(row["window_class"]), _numpy(row["repeated"]))]
        return merged(np.concatenate([*starts, place]), np.concatenate([*ends, place + length]))

    def strings(kept: list[bytes]) -> pa.Array:
        return pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())

    def keep(parts):
        for batch in parts:
            for i in range(len(batch)):
                row = {c: batch.column(k)[i] for k, c in enumerate(batch.schema.names)}
                starts, ends = covered(row)
                texts = row["texts"].values.to_pylist()
                sizes = np.array([len(t) for t in texts], np.int64)
                begin = np.cumsum(sizes + 1) - sizes - 1
                # Intervals never cross texts, so each text has a run of them.
                low, high = np.searchsorted(starts, begin), np.searchsorted(starts, begin + sizes)
                kept, removed = [], []
                for text, base_, a, b in zip(texts, begin.tolist(), low.tolist(), high.tolist()):
                    cuts = [0, *(np.stack([starts[a:b], ends[a:b]], 1) - base_).ravel().tolist(), len(text)]
                    kept.append(b"".join([text[x:y] for x, y in zip(cuts[::2], cuts[1::2])]) if b > a else text)
                    removed.append(len(text) - len(kept[-1]))
                numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, high - low)]
                yield pa.RecordBatch.from_arrays(
                    [row["rows"].values, strings(kept), *numbers], names=["row", "kept", "n_bytes", "n_removed", "n_spans"]
                )

    kind = base.schema["rows"].dataType.elementType.simpleString()
    needed = ["rows", "texts", "starts", "ends", "cut", "place", "windows", "same", "asked", "settled", "at_place", "window_class", "repeated"]
    shape = f"row {kind}, kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long"
    return final.select(*needed).mapInArrow(keep, shape)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that start at two places."""
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", kept)
