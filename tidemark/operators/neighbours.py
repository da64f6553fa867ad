"""``lead`` and ``lag`` over a key's timeline that do not put a hot key into one task.

A plain window sends all rows of a key to one task. Here a key with more than ``hot_rows`` rows has its
timeline cut into segments, as many as its own rows ask for; the window runs per (key, segment), and the
value missing at a segment's edge is taken from a summary with one row per (key, segment). Cuts are values
of the sequence itself, taken from a sample by hash, so any type that can be ordered will do. Where the
cuts fall only decides how evenly the work is spread; the result is the same for any cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.workspace import scratch_path

HOT_ROWS = 1_000_000
SAMPLES_PER_SEGMENT = 20
_CUTS_PER_GROUP = 100

_SEGMENT = "__segment"
_CUTS = "__cuts"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder, so that readers share one computation of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and ``__rows``; counts are pre-aggregated and read key columns only."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.where(F.col("__rows") > hot_rows)


def cut_points(df: DataFrame, keys: list[str], sequence: str, hot_rows: int) -> DataFrame | None:
    """Per hot key the sorted sequence values that cut its timeline, or None if no key is hot.

    A key is sampled at a rate that leaves about ``SAMPLES_PER_SEGMENT`` values per segment, so the samples
    are a fixed small share of the rows whatever the number of hot keys.
    """
    hot = written(hot_keys(df, keys, hot_rows), "hot-keys")
    if not hot.take(1):
        return None
    rate = max(1, hot_rows // SAMPLES_PER_SEGMENT)
    chosen = F.pmod(F.xxhash64(*keys, sequence), F.lit(rate)) == 0
    sampled = df.select(*keys, sequence).where(F.col(sequence).isNotNull() & chosen).join(hot, keys)
    values = F.sort_array(F.collect_set(sequence)).alias("__values")
    per_key = sampled.groupBy(*keys).agg(values, F.first("__rows").alias("__rows"))
    segments = F.ceil(F.col("__rows") / hot_rows) + 1
    step = F.greatest(F.lit(1), F.floor(F.size("__values") / segments)).cast("int")
    cuts = F.filter("__values", lambda _, i: (i > 0) & (i % step == 0))
    return written(hot.select(*keys).join(per_key.select(*keys, cuts.alias(_CUTS)), keys, "left"), "cuts")


def _passed(value: Column) -> Column:
    """How many cuts are at or before ``value``: first among every hundredth cut, then within that group."""
    cuts = F.col(_CUTS)
    group = F.size(F.filter(cuts, lambda c, i: (i % _CUTS_PER_GROUP == 0) & (c <= value)))
    before = F.greatest(F.lit(0), group - 1) * _CUTS_PER_GROUP
    return before + F.size(F.filter(F.slice(cuts, before + 1, F.lit(_CUTS_PER_GROUP)), lambda c: c <= value))


class Timeline:
    """Rows of ``df`` spread over (key, segment) groups, for neighbour lookups along ``sequence``.

    NULL sequences sort first. Unless ``hot_rows`` is None, jobs that count rows per key run at once; if a
    key is hot, the rows are written with their segments, and read from there.
    """

    def __init__(self, df: DataFrame, keys: list[str], sequence: str, hot_rows: int | None = HOT_ROWS):
        self.keys = list(keys)
        self.sequence = sequence
        cuts = None if hot_rows is None else cut_points(df, keys, sequence, hot_rows)
        self.hot = cuts is not None
        self.rows = written(self._with_segments(df, cuts), "segments") if self.hot else df

    @property
    def _group(self) -> list[str]:
        return self.keys + [_SEGMENT] if self.hot else self.keys

    def _with_segments(self, df: DataFrame, cuts: DataFrame) -> DataFrame:
        """Segment 0 holds the keys that are not hot; those of hot keys count from 1."""
        is_hot = cuts.withColumn("__hot", F.lit(True))
        inside = F.coalesce(_passed(F.col(self.sequence)), F.lit(0)) + 1
        segment = F.when(F.col("__hot").isNull(), F.lit(0)).when(F.col(_CUTS).isNull() | F.col(self.sequence).isNull(), F.lit(1))
        joined = df.join(is_hot, self.keys, "left")
        return joined.withColumn(_SEGMENT, segment.otherwise(inside).cast("int")).drop(_CUTS, "__hot")

    def _edges(self, edge: Column, pick) -> DataFrame:
        along = Window.partitionBy(*self.keys).orderBy(_SEGMENT)
        summary = self.rows.where(F.col(_SEGMENT) > 0).groupBy(*self._group).agg(edge.alias("__edge"))
        return summary.select(*self._group, pick("__edge").over(along).alias("__beyond"))

    def _looked_up(self, name: str, nearest: Column, edges: DataFrame) -> "Timeline":
        rows = (
            self.rows.withColumn("__nearest", nearest)
            .join(edges, self._group, "left")
            .withColumn(name, F.coalesce("__nearest", "__beyond"))
            .drop("__nearest", "__beyond")
        )
        return self._like(rows)

    def with_next_sequence(self, name: str, order: list[Column]) -> "Timeline":
        """Add ``name``: the sequence of the key's next row in ``order`` (sequence, then ties)."""
        within = Window.partitionBy(*self._group).orderBy(F.col(self.sequence), *order)
        nearest = F.lead(self.sequence).over(within)
        if not self.hot:
            return self._like(self.rows.withColumn(name, nearest))
        return self._looked_up(name, nearest, self._edges(F.min(self.sequence), F.lead))

    def with_previous(self, name: str, value: Column, order: list[Column]) -> "Timeline":
        """Add ``name``: ``value`` (never NULL itself) of the key's previous row in ``order``."""
        within = Window.partitionBy(*self._group).orderBy(F.col(self.sequence), *order)
        nearest = F.lag(value).over(within)
        if not self.hot:
            return self._like(self.rows.withColumn(name, nearest))
        last = F.max_by(value, F.struct(F.col(self.sequence), *order))
        return self._looked_up(name, nearest, self._edges(last, F.lag))

    def where(self, condition: Column) -> "Timeline":
        return self._like(self.rows.where(condition))

    def drop(self, *names: str) -> "Timeline":
        return self._like(self.rows.drop(*names))

    def settled(self) -> "Timeline":
        """Written, where segments make the next lookup read the rows twice."""
        return self._like(written(self.rows, "segments")) if self.hot else self

    def result(self) -> DataFrame:
        return self.rows.drop(_SEGMENT)

    def _like(self, rows: DataFrame) -> "Timeline":
        twin = object.__new__(Timeline)
        twin.keys, twin.sequence, twin.hot, twin.rows = self.keys, self.sequence, self.hot, rows
        return twin
