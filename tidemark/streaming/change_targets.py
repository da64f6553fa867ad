"""Incremental SCD tables kept as partitioned Parquet tables, of which a batch rewrites the partitions it touches.

The state of a type 2 target holds one row per version: the keys, the half-open span ``[__seq, __end)`` and the
kept columns; deletes stay as rows, and every key's timeline starts with a version without a start or content, so that
each event falls into a stored version. It is partitioned by period and bucket: the open versions have a period of
their own, closed ones that of their end, and the bucket is a hash of the keys. A type 1 target holds the latest
event per key, by bucket.

A batch finds the versions its events fall into: the open ones of its buckets, and, only if some event is late, closed
ones of its buckets that end in the late events' periods or after. The versions that change are joined to the rest of
their partitions, which are folded by key and start (the least end, the greatest content) and replaced by dynamic
partition overwrite. What is read and written thus depends on the touched buckets and periods; a bucket that grows
beyond ``bucket_rows`` open versions makes the next state have ``GROWTH`` times as many buckets. A change of the
layout (buckets, new columns) writes the whole state once more; the former one stays as a folder that is not read.

Folding is a maximum over contents and a minimum over ends, so batches may come in any order and more than once:
late events, replays and restarts all lead to the state of one full rebuild. The new partitions are written
beside the state first and marked as complete, so a job that dies while it replaces them does so again when it is
restarted. One job writes a target at a time; a reader during the replacement may miss the partition in hand.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.operators.cdc import (
    DELETED,
    END_AT,
    ENTRIES,
    ROW,
    SEQ,
    START_AT,
    ChangeRules,
    current_rows,
    latest_points,
    reject_reason,
    split_rejects,
)
from tidemark.operators.neighbours import HOT_ROWS, Timeline
from tidemark.streaming.sinks import for_each_batch
from tidemark.streaming.tables import AuditedTable, define_view, found_or_none, merge_schema, write_line

BUCKETS = 8
BUCKET_ROWS = 1_000_000
GROWTH = 4
#: Groups over which events that cannot be applied are dealt.
LANES = 256

_END = "__end"
_PERIOD = "__period"
_BUCKET = "__bucket"
_OPEN = "open"
_LANE = "__lane"
_EVENT = "__event"
_SPANS = 16
_NOTES = "version int, buckets int, schema_json string, columns array<string>"


def month_or_all(end: Column, kind: T.DataType) -> Column:
    """The default period of a closed version: the month of its end, or one period for ends that are no times.

    Periods must sort like ends, as text, and before ``open``."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(end, "yyyy-MM")
    return F.lit("closed")


class ChangeTarget:
    """A table of SCD type 1 or 2 at ``path``, fed with :meth:`merge`.

    ``name`` and ``comment`` give it a place in the catalog: a view of what :meth:`read` gives.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        rules: ChangeRules,
        scd_type: int = 1,
        buckets: int = BUCKETS,
        hot_rows: int | None = HOT_ROWS,
        bucket_rows: int = BUCKET_ROWS,
        period: Callable[[Column, T.DataType], Column] = month_or_all,
        name: str | None = None,
        comment: str | None = None,
    ):
        if scd_type not in (1, 2):
            raise ValueError(f"scd_type must be 1 or 2, not {scd_type}")
        if buckets < 1 or bucket_rows < 1:
            raise ValueError("buckets and bucket_rows must be at least 1")
        self.spark = spark
        self.path = path.rstrip("/")
        self.rules = rules
        self.scd_type = scd_type
        self.first_buckets = buckets
        self.hot_rows = hot_rows
        self.bucket_rows = bucket_rows
        self.period = period
        self.rejects = AuditedTable(spark, f"{self.path}/rejects")
        self._known: dict | None = None
        self._held: list[DataFrame] = []
        self.name, self.comment = name, comment
        self._published = self._settled = False

    # -- the state -----------------------------------------------------------------------

    def notes(self) -> dict | None:
        """Layout of the state: version, buckets, schema, and the target's columns as first seen; None if unwritten."""
        if self._known is None:
            rows = found_or_none(lambda: self.spark.read.schema(_NOTES).json(f"{self.path}/notes/*"))
            found = rows.orderBy(F.desc("version")).limit(1).collect() if rows is not None else []
            self._known = found[0].asDict() if found else None
        return self._known

    def _lay_out(self, buckets: int, schema: T.StructType, columns: list[str]) -> None:
        """Take up a change of the layout: the whole state is written once more under it, and then taken instead."""
        last, stored = self.notes(), self.state()
        row = {"buckets": buckets, "schema_json": schema.json(), "columns": columns}
        if last and all(last[k] == v for k, v in row.items()):
            return
        row["version"] = last["version"] + 1 if last else 0
        if stored is not None:
            content = F.when(F.col(ROW).isNotNull(), _fitted(stored, schema[ROW].dataType)).alias(ROW)
            moved = stored.select(*self.rules.keys, SEQ, _END, content, _PERIOD, self._bucket(buckets).alias(_BUCKET))
            moved.hint("rebalance", _PERIOD, _BUCKET).write.mode("overwrite").partitionBy(_PERIOD, _BUCKET).parquet(
                f"{self.path}/state-{row['version']}"
            )
        write_line(self.spark, f"{self.path}/notes/{row['version']}", row)
        self._known, self._published = row, False

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.notes()["schema_json"]))

    @property
    def buckets(self) -> int:
        last = self.notes()
        return last["buckets"] if last else self.first_buckets

    def _state_path(self) -> str:
        return f"{self.path}/state-{self.notes()['version']}"

    def state(self) -> DataFrame | None:
        """All stored rows with their partition columns, or None before the first batch."""
        if self.notes() is None:
            return None
        whole = T.StructType([*self.schema.fields]).add(_PERIOD, "string").add(_BUCKET, "integer")
        return found_or_none(lambda: self.spark.read.schema(whole).parquet(self._state_path()))

    def _scan(self, condition: Column) -> DataFrame:
        """Stored rows of the partitions that ``condition`` names."""
        return self.state().where(condition)

    def _placed(self, rows: DataFrame) -> DataFrame:
        kind = rows.schema[_END].dataType
        period = F.when(F.col(_END).isNull(), F.lit(_OPEN)).otherwise(self.period(F.col(_END), kind))
        return rows.withColumn(_PERIOD, period).withColumn(_BUCKET, self._bucket(self.buckets))

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.rules.keys), F.lit(buckets)).cast("int")

    # -- writes --------------------------------------------------------------------------

    def merge(self, changes: DataFrame, writer: str, number: int) -> None:
        """Apply one batch of change events. A batch that is applied again changes nothing."""
        try:
            self._merge(changes, writer, number)
        finally:
            while self._held:
                self._held.pop().unpersist()

    def _hold(self, rows: DataFrame) -> DataFrame:
        """``rows``, kept until the end of the merge."""
        self._held.append(rows.persist())
        return rows

    def _merge(self, changes: DataFrame, writer: str, number: int) -> None:
        self._finish()
        rules, keys = self.rules, self.rules.keys
        _, refused = split_rejects(changes, keys, rules.sequence_by)
        if not refused.isEmpty():
            self.rejects.append(refused, writer, number, "REJECT")
        points = rules.points(changes)
        if self.scd_type == 1:
            points = latest_points(points, keys)
        else:
            points = points.groupBy(*keys, SEQ).agg(F.max(ROW).alias(ROW))
        points = self._hold(points)
        last = self.notes()
        whole = T.StructType([*points.schema.fields[:-1], T.StructField(_END, points.schema[SEQ].dataType), points.schema[ROW]])
        columns = list(dict.fromkeys([*(last["columns"] if last else []), *rules.kept_columns(changes.columns)]))
        self._lay_out(self.buckets, merge_schema(self.schema if last else None, whole), columns)
        points = points.select(*keys, SEQ, _fitted(points, self.schema[ROW].dataType).alias(ROW))
        touched = [r[0] for r in points.select(self._bucket(self.buckets)).distinct().collect()]
        if not touched:
            return
        image = self._latest(points, touched) if self.scd_type == 1 else self._versions(points, touched)
        if image is None:
            return
        # Rows of a partition go to few files, those of a large one to several.
        image.hint("rebalance", _PERIOD, _BUCKET).write.mode("overwrite").partitionBy(_PERIOD, _BUCKET).parquet(self._image_path())
        self._mark("complete")
        self._replace()
        image = self._image().where(F.col(_PERIOD) == _OPEN)
        if image.count() > self.bucket_rows * len(touched):
            self._lay_out(self.buckets * GROWTH, self.schema, self.notes()["columns"])
        self._publish()

    def _latest(self, points: DataFrame, touched: list[int]) -> DataFrame:
        rows = points
        if self.state() is not None:
            rows = rows.unionByName(self._scan(F.col(_BUCKET).isin(touched)).select(*points.columns))
        no_end = F.lit(None).cast(points.schema[SEQ].dataType)
        return self._placed(latest_points(rows, self.rules.keys).withColumn(_END, no_end))

    def _versions(self, points: DataFrame, touched: list[int]) -> DataFrame | None:
        keys = self.rules.keys
        near = self._near(points, touched) if self.state() is not None else None
        changed = self._hold(self._placed(self._changed(points, near)))
        moved = changed.select(_PERIOD, _BUCKET)
        if near is not None:
            # Versions that close or split leave their partition, which is replaced without them.
            again = changed.select(*[F.col(c).alias(f"__{c}") for c in (*keys, SEQ)])
            same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*keys, SEQ)])
            left = self._placed(near.join(again, same, "left_semi"))
            moved = moved.unionByName(left.select(_PERIOD, _BUCKET))
        places = moved.distinct().collect()
        if not places:
            return None
        rows = changed
        if near is not None:
            pruned = F.col(_PERIOD).isin(sorted({p[0] for p in places})) & F.col(_BUCKET).isin(sorted({p[1] for p in places}))
            exact = self.spark.createDataFrame(places, f"{_PERIOD} string, {_BUCKET} int")
            rows = self._scan(pruned).join(exact, [_PERIOD, _BUCKET], "left_semi").unionByName(changed)
        folded = rows.groupBy(*keys, SEQ).agg(F.min(_END).alias(_END), F.max(ROW).alias(ROW))
        return self._placed(folded.select(*self.schema.names))

    def _near(self, points: DataFrame, touched: list[int]) -> DataFrame:
        """The stored versions that the batch's events fall into, and for late events some between them; written."""
        keys, kind = self.rules.keys, points.schema[SEQ].dataType
        here = F.col(_BUCKET).isin(touched)
        asked = points.select(*keys).distinct()
        opened = self._scan(here & (F.col(_PERIOD) == _OPEN)).select(*self.schema.names).join(asked, keys, "left_semi")
        opened = self._hold(opened)
        starts = opened.select(*keys, F.col(SEQ).alias("__open"))
        late = self._hold(points.join(starts, keys).where(F.col(SEQ) < F.col("__open")).select(*keys, SEQ))
        low, period, place, far = late.agg(
            F.min(SEQ).cast("string"), F.min(self.period(F.col(SEQ), kind)), F.min(_as_number(kind)), F.max(_as_number(kind))
        ).first()
        if low is None:
            return opened
        width = ((far - place) / _SPANS) or 1.0
        span = F.floor((_as_number(kind) - F.lit(place)) / F.lit(width)).alias("__span")
        # The late events of a key as at most _SPANS + 1 spans, so that one event does not ask for all versions
        # between it and the newest one.
        spans = late.groupBy(*keys, span).agg(F.min(SEQ).alias("__low"), F.max(SEQ).alias("__high")).drop("__span")
        closed = self._scan(here & (F.col(_PERIOD) != _OPEN) & (F.col(_PERIOD) >= period))
        closed = closed.where(F.col(_END) > F.lit(low).cast(kind)).select(*self.schema.names)
        into = (F.col(SEQ).isNull() | (F.col(SEQ) <= F.col("__high"))) & (F.col(_END) > F.col("__low"))
        match = reduce(Column.__and__, [closed[k] == spans[k] for k in keys]) & into
        return self._hold(opened.unionByName(closed.join(spans, match, "left_semi")))

    def _changed(self, points: DataFrame, near: DataFrame | None) -> DataFrame:
        """New versions, and stored ones whose end changed."""
        keys = self.rules.keys
        no_end = F.lit(None).cast(points.schema[SEQ].dataType)
        no_row = F.lit(None).cast(self.schema[ROW].dataType)

        def mark(end, stored: bool, new: bool, row):
            return [end.alias(_END), F.lit(stored).alias("__stored"), F.lit(new).alias("__new"), row.alias(ROW)]

        marks = points.select(*keys, SEQ, *mark(no_end, False, True, F.col(ROW)))
        asked = points.select(*keys).distinct()
        if near is not None:
            asked = asked.join(near.select(*keys).distinct(), keys, "left_anti")
            # The end of a version is the start of the next one, which itself may not be near.
            begin = F.struct(F.col(SEQ), *mark(F.col(_END), True, False, F.col(ROW)))
            end = F.struct(F.col(_END).alias(SEQ), *mark(no_end, False, False, no_row))
            stored = near.select(*keys, F.inline(F.array(begin, end))).where(F.col("__stored") | F.col(SEQ).isNotNull())
            marks = marks.unionByName(stored)
        # The timeline of a new key starts with a version without a start, so that every event has one before it.
        marks = marks.unionByName(asked.select(*keys, no_end.alias(SEQ), *mark(no_end, True, False, no_row)))
        folded = marks.groupBy(*keys, SEQ).agg(
            F.min(_END).alias(_END), F.max("__stored").alias("__stored"), F.max("__new").alias("__new"), F.max(ROW).alias(ROW)
        )
        folded = self._hold(folded)
        # Rows per key are counted only where there are enough rows for a hot key.
        hot = self.hot_rows if self.hot_rows is not None and folded.count() > self.hot_rows else None
        line = Timeline(folded, keys, SEQ, hot).with_next_sequence("__next", []).result()
        cut = F.col("__stored") & ~F.col("__next").eqNullSafe(F.col(_END))
        rows = line.where(F.col("__new") | cut).select(*keys, SEQ, F.col("__next").alias(_END), ROW)
        return rows.select(*self.schema.names)

    # -- replacing partitions ------------------------------------------------------------

    def _image_path(self) -> str:
        return f"{self.path}/image"

    def _image(self) -> DataFrame:
        whole = T.StructType([*self.schema.fields]).add(_PERIOD, "string").add(_BUCKET, "integer")
        return self.spark.read.schema(whole).parquet(self._image_path())

    def _mark(self, stage: str) -> None:
        write_line(self.spark, f"{self.path}/image-mark", {"stage": stage})

    def _finish(self) -> None:
        """Replace the partitions of a complete image that a job left which died."""
        if self._settled:
            return
        mark = found_or_none(lambda: self.spark.read.schema("stage string").json(f"{self.path}/image-mark"))
        if mark is not None and mark.where("stage = 'complete'").take(1):
            self._replace()
        self._settled = True

    def _replace(self) -> None:
        self._settled = False
        writer = self._image().write.mode("overwrite").partitionBy(_PERIOD, _BUCKET)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self._state_path())
        self._mark("replaced")
        self._settled = True

    # -- reads ---------------------------------------------------------------------------

    def _publish(self) -> None:
        """The catalog view over the state; made anew when the layout has changed."""
        if not self.name or self._published or self.state() is None:
            return
        entries = self.schema[ROW].dataType.names

        def told(name: str) -> str:
            if name in self.rules.keys:
                return f"`{name}`"
            if (held := f"{ENTRIES}{name}") in entries:
                return f"map_from_entries({ROW}.`{held}`) AS `{name}`"
            return f"{ROW}.`{name}` AS `{name}`"

        columns = [told(c) for c in self.notes()["columns"]]
        if self.scd_type == 2:
            columns += [f"{SEQ} AS {START_AT}", f"{_END} AS {END_AT}"]
        query = f"SELECT {', '.join(columns)} FROM parquet.`{self._state_path()}` WHERE NOT {ROW}.{DELETED}"
        define_view(self.spark, self.name, query, self.comment)
        self._published = True

    def read(self) -> DataFrame:
        """The SCD table: current rows (type 1) or versions with start and end (type 2)."""
        stored = self.state()
        if self.notes() is None:
            raise ValueError(f"target {self.path} has not been written")
        if stored is None:
            # All batches so far were empty.
            stored = self.spark.createDataFrame([], self.schema)
        columns = self.rules.unpack(self.notes()["columns"], stored)
        # A version without a start has no content and is left out with the deletes.
        rows = current_rows(stored)
        if self.scd_type == 1:
            return rows.select(*columns)
        return rows.select(*columns, F.col(SEQ).alias(START_AT), F.col(_END).alias(END_AT))


def _fitted(points: DataFrame, wanted: T.StructType) -> Column:
    """The content of ``points`` with the fields of ``wanted``, NULL where a batch lacks one."""
    held = points.schema[ROW].dataType.names
    return F.struct(*[(F.col(f"{ROW}.`{f.name}`") if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted])


def _as_number(kind: T.DataType) -> Column:
    """The sequence as a double, good enough to tell close points from distant ones."""
    if isinstance(kind, T.NumericType):
        return F.col(SEQ).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(SEQ).cast("timestamp")).cast("double")
    return F.lit(0.0)


def merge_into(changes: DataFrame, targets: list[ChangeTarget], writer: str, number: int) -> None:
    """Apply one batch to several targets, reading the batch once."""
    changes.persist()
    try:
        for target in targets:
            target.merge(changes, writer, number)
    finally:
        changes.unpersist()


def apply_changes(
    changes: DataFrame,
    targets: list[ChangeTarget],
    checkpoint: str,
    trigger: str = "available_now",
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Keep ``targets`` up to date from a stream of change events."""

    def run(batch: DataFrame, writer: str, number: int) -> None:
        merge_into(batch, targets, writer, number)

    return for_each_batch(changes, run, checkpoint, trigger, interval, name)


def latest_by_key(
    changes: DataFrame, rules: ChangeRules
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]:
    """SCD type 1 as keyed streaming state, and the functions that read its output.

    The first item is a streaming DataFrame for output mode ``update``: each micro-batch emits the latest event of
    the keys it changed, and the events that cannot be applied. The second gives the current rows of what was
    emitted, the third the rejects with their reason. The state holds one value per key; rejects are dealt over
    ``LANES`` groups of their own, so that a null key that many events share is no hot group, and leave no state.
    The query must start with the settings ``KEYED_STATE`` (:func:`for_each_batch` takes them), as Spark's default
    state store cannot hold this state.
    """
    kept = rules.kept_columns(changes.columns)
    applicable = rules.is_applicable()
    columns = [F.col(f"`{c}`") for c in changes.columns]
    lane = F.when(applicable, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*[c for c in columns if _can_hash(changes, c)]), F.lit(LANES)).cast("int"))
    reason = F.when(~applicable, reject_reason(rules.sequence_by)).alias("reject_reason")
    refused = F.when(~applicable, F.struct(*columns)).alias(_EVENT)
    events = changes.select(lane.alias(_LANE), *rules.keys, *rules.point(changes), reason, refused)
    shape = T.StructType([f for f in events.schema if f.name != _LANE])
    grouped = events.groupBy(_LANE, *rules.keys)
    emitted = grouped.transformWithState(LatestEvent(events.schema, rules.keys), shape.toNullable(), "Update", "None")

    def read(rows: DataFrame) -> DataFrame:
        updates = rows.where("reject_reason is null").select(*rules.keys, SEQ, ROW)
        return current_rows(latest_points(updates, rules.keys)).select(*rules.unpack(kept, updates))

    def rejects(rows: DataFrame) -> DataFrame:
        return rows.where("reject_reason is not null").select(f"{_EVENT}.*", "reject_reason")

    return emitted, read, rejects


def _can_hash(df: DataFrame, column: Column) -> bool:
    """Maps have no hash."""
    return "map<" not in df.select(column).schema[0].dataType.simpleString()


def in_order(value) -> tuple:
    """A key by which Python orders a value as Spark does: NULL first, then by content; NaN after all numbers."""
    if value is None:
        return (0,)
    if isinstance(value, (tuple, list)):
        return (1, tuple(in_order(v) for v in value))
    if isinstance(value, float) and value != value:
        return (2,)
    return (1, value)


class LatestEvent(StatefulProcessor):
    """Keeps the greatest event of a key and emits it when it changes; passes rejects on."""

    def __init__(self, schema: T.StructType, keys: list[str]):
        self.held = T.StructType([schema[SEQ], schema[ROW]]).toNullable()
        self.names = [*keys, SEQ, ROW, "reject_reason", _EVENT]

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", self.held)

    def handleInputRows(self, key, rows, timerValues):
        lane, *values = tuple(key)
        best, refused = None, lane >= 0

        def told(*content):
            return Row(**dict(zip(self.names, (*values, *content))))

        for row in rows:
            if refused:
                yield told(None, None, row["reject_reason"], row[_EVENT])
            else:
                point = (row[SEQ], row[ROW])
                if best is None or in_order(point) > in_order(best):
                    best = point
        if best is not None:
            before = self.last.get() if self.last.exists() else None
            if before is None or in_order(best) > in_order(tuple(before)):
                self.last.update(best)
                yield told(*best, None, None)

    def close(self) -> None:
        pass
