"""Change feeds to current (SCD type 1) and historical (SCD type 2) tables.

Rules shared by the batch functions here and the incremental targets in ``streaming``:

* only the delete predicate matters; any other event inserts or updates its key;
* events are ordered by the sequence column, never by arrival;
* of several events with one key and sequence the last by tie-breakers wins, then by the kept
  columns themselves, so the winner does not depend on arrival order;
* maps cannot be ordered, so a point holds a map column as its sorted entries and gives it back as a map;
* a delete predicate that evaluates to NULL is not a delete;
* events with a NULL key or NULL sequence are not applied, see :func:`split_rejects`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.neighbours import HOT_ROWS, Timeline, hot_keys, written

START_AT = "__START_AT"
END_AT = "__END_AT"
SEQ = "__seq"
ROW = "__row"
DELETED = "__deleted"


@dataclass(frozen=True)
class ChangeRules:
    """How a change feed is applied: keys, order, deletes and the columns left out."""

    keys: list[str]
    sequence_by: str
    apply_as_deletes: str | None = None
    except_columns: list[str] = field(default_factory=list)
    tie_breakers: list[str] = field(default_factory=list)

    def kept_columns(self, columns: list[str]) -> list[str]:
        missing = [c for c in [*self.keys, self.sequence_by, *self.tie_breakers] if c not in columns]
        if missing:
            raise ValueError(f"change feed has no column {', '.join(missing)}")
        dropped = set(self.except_columns)
        if dropped & set(self.keys):
            raise ValueError("a key column cannot be left out")
        return [c for c in columns if c not in dropped]

    def is_applicable(self) -> Column:
        condition = F.col(self.sequence_by).isNotNull()
        for key in self.keys:
            condition = condition & F.col(key).isNotNull()
        return condition

    def points(self, log: DataFrame) -> DataFrame:
        """Keys, ``__seq`` and ``__row`` (tie-breakers, delete flag, kept columns) of each event."""
        return log.where(self.is_applicable()).select(*self.keys, *self.point(log))

    def point(self, log: DataFrame) -> list[Column]:
        """``__seq`` and ``__row`` of an event of ``log``."""
        kept = self.kept_columns(log.columns)
        deleted = F.coalesce(F.expr(self.apply_as_deletes), F.lit(False)) if self.apply_as_deletes else F.lit(False)
        ties = [F.col(c).alias(f"__tie{i}") for i, c in enumerate(self.tie_breakers)]
        payload = [_held(log.schema[c]) for c in kept if c not in self.keys]
        return [F.col(self.sequence_by).alias(SEQ), F.struct(*ties, deleted.alias(DELETED), *payload).alias(ROW)]

    def unpack(self, kept: list[str], points: DataFrame) -> list[Column]:
        """The kept columns of ``points`` as they came."""
        held = points.schema[ROW].dataType.names

        def given(name: str) -> Column:
            if name in self.keys:
                return F.col(name)
            if ENTRIES + name in held:
                return F.map_from_entries(F.col(f"{ROW}.`{ENTRIES}{name}`")).alias(name)
            return F.col(f"{ROW}.`{name}`").alias(name)

        return [given(c) for c in kept]


ENTRIES = "__entries_of_"


def _held(column: T.StructField) -> Column:
    """A payload column in a form that can be ordered."""
    if isinstance(column.dataType, T.MapType):
        return F.sort_array(F.map_entries(F.col(column.name))).alias(ENTRIES + column.name)
    return F.col(column.name)


def _content(name: str, points: DataFrame) -> Column:
    held = points.schema[ROW].dataType.names
    return F.col(f"{ROW}.`{ENTRIES + name if ENTRIES + name in held else name}`")


def split_rejects(log: DataFrame, keys: list[str], sequence_by: str) -> tuple[DataFrame, DataFrame]:
    """Applicable events, and the others with a ``reject_reason``."""
    rules = ChangeRules(keys, sequence_by)
    return (
        log.where(rules.is_applicable()),
        log.where(~rules.is_applicable()).withColumn("reject_reason", reject_reason(sequence_by)),
    )


def reject_reason(sequence_by: str) -> Column:
    """Why an event that is not applicable is refused."""
    return F.when(F.col(sequence_by).isNull(), F.lit("null sequence")).otherwise(F.lit("null key"))


def scd1(
    log: DataFrame,
    keys: list[str],
    sequence_by: str,
    apply_as_deletes: str | None = None,
    except_columns: list[str] | None = None,
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """Latest row per key; keys whose latest event is a delete are absent.

    One aggregation with map-side combine, so a hot key reaches the shuffle as one row per task.
    """
    rules = ChangeRules(keys, sequence_by, apply_as_deletes, except_columns or [], tie_breakers or [])
    kept = rules.kept_columns(log.columns)
    points = rules.points(log)
    return current_rows(latest_points(points, keys)).select(*rules.unpack(kept, points))


def latest_points(points: DataFrame, keys: list[str]) -> DataFrame:
    """One point per key: the greatest by sequence, ties and content."""
    latest = F.max(F.struct(SEQ, ROW)).alias("__last")
    return points.groupBy(*keys).agg(latest).select(*keys, f"__last.{SEQ}", f"__last.{ROW}")


def current_rows(points: DataFrame) -> DataFrame:
    return points.where(~F.col(f"{ROW}.{DELETED}"))


def scd2(
    log: DataFrame,
    keys: list[str],
    sequence_by: str,
    apply_as_deletes: str | None = None,
    except_columns: list[str] | None = None,
    tie_breakers: list[str] | None = None,
    collapse_unchanged: bool = False,
    track: list[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """All versions of each key with half-open ``[__START_AT, __END_AT)``; NULL end is current.

    ``collapse_unchanged`` opens a new version only where a tracked column (default: every kept
    column but the sequence) or the delete flag differs from the key's previous event.
    Unless ``hot_rows`` is None, a job that counts rows per key runs when the function is called.
    """
    rules = ChangeRules(keys, sequence_by, apply_as_deletes, except_columns or [], tie_breakers or [])
    kept = rules.kept_columns(log.columns)
    points = rules.points(log)
    ties = [F.col(ROW)]
    if hot_rows is not None and hot_keys(points, keys, hot_rows).take(1):
        # Copies of one event meet here, spread by their sequence, and not in the task of a segment.
        points = written(points.groupBy(*keys, SEQ).agg(F.max(ROW).alias(ROW)), "points")
        line, ties = Timeline(points, keys, SEQ, hot_rows), []
    else:
        line = Timeline(points, keys, SEQ, None)
    if collapse_unchanged:
        line = _changed_only(line, rules, kept, track, ties)
    else:
        line = line.with_next_sequence("__next", ties)
        # A row followed by its own sequence lost the tie and would be a version of no length.
        line = line.where(F.col("__next").isNull() | (F.col("__next") > F.col(SEQ)))
    return (
        line.result()
        .where(~F.col(f"{ROW}.{DELETED}"))
        .select(*rules.unpack(kept, points), F.col(SEQ).alias(START_AT), F.col("__next").alias(END_AT))
    )


def _changed_only(line: Timeline, rules: ChangeRules, kept: list[str], track: list[str] | None, ties: list[Column]) -> Timeline:
    if ties:
        line = line.with_next_sequence("__next", ties)
        line = line.where(F.col("__next").isNull() | (F.col("__next") > F.col(SEQ))).drop("__next")
    tracked = track or [c for c in kept if c not in rules.keys and c != rules.sequence_by]
    content = F.struct(F.col(f"{ROW}.{DELETED}"), *[_content(c, line.rows) for c in tracked])
    line = line.with_previous("__before", content, [])
    line = line.where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(content)).drop("__before")
    return line.settled().with_next_sequence("__next", [])


def current_versions(history: DataFrame, end_at: str = END_AT) -> DataFrame:
    """Rows of a versioned table that are valid now."""
    return history.where(F.col(end_at).isNull())
