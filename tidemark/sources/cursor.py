"""Cursor-column pulls: the rows of a table changed since the last pull.

Deletes leave no row to pull, so they are not seen; of several changes of a row between two
pulls only the last is seen.
"""

from __future__ import annotations

import inspect
import math
import re
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


SAMPLES_PER_PART = 500
_MICROS = re.compile(r"-?\d+ us")


def cursor_text(df: DataFrame, cursor: str) -> Column:
    """The greatest cursor value of ``df`` as text that means the same in every session.

    An instant is kept as microseconds since 1970 in UTC, anything else as Spark prints it.
    """
    greatest = F.max(cursor)
    if isinstance(df.schema[cursor].dataType, T.TimestampType):
        return F.concat(F.unix_micros(greatest).cast("string"), F.lit(" us"))
    return greatest.cast("string")


def cursor_value(text: str, kind: T.DataType) -> Column:
    """The value that :func:`cursor_text` kept; plain texts are cast."""
    if isinstance(kind, T.TimestampType) and _MICROS.fullmatch(text):
        return F.timestamp_micros(F.lit(int(text.split()[0])))
    return F.lit(text).cast(kind)


def pull_by_cursor(read: Callable[..., DataFrame], cursor: str, last_value: str | None = None) -> DataFrame:
    """Rows whose cursor is at or after ``last_value`` (text); all rows on the first pull.

    At, not after: rows that share the last cursor value may arrive after a pull. Applying them
    twice changes nothing, because change targets order and fold by key and cursor. The
    comparison is a plain column filter, so Spark pushes it to the source. A reader that takes the
    cursor and its last value (as :func:`jdbc_reader`'s does) is given them.
    """
    table = read(cursor, last_value) if len(inspect.signature(read).parameters) >= 2 else read()
    if last_value is None:
        return table
    return table.where(F.col(cursor) >= cursor_value(last_value, table.schema[cursor].dataType))


def even_cuts(rows: DataFrame, cursor: str, parts: int, tie: str | None = None, per_part: int = SAMPLES_PER_PART) -> list[tuple]:
    """At most ``parts - 1`` cuts of ``rows`` into even parts by ``cursor``, then by ``tie``.

    They are quantiles of a sample by hash, about ``per_part`` values a part whatever the size of the table, so
    they fall where the rows are. ``tie``, such as the primary key, tells the rows of one cursor value apart: a cut may
    then lie within that value, and the sample draws its rows one by one.
    """
    columns = [cursor, *([tie] if tie else [])]
    known = rows.select(*columns).where(F.col(cursor).isNotNull())
    total = known.count()
    wanted = parts * per_part
    if total > wanted:
        # Rows of one cursor value are drawn apart by their tie.
        rate = math.ceil(wanted / total * (1 << 40))
        known = known.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < rate)
    ordered = known.orderBy(*columns).collect()
    places = sorted({len(ordered) * i // parts for i in range(1, parts)})
    return list(dict.fromkeys(tuple(ordered[i]) for i in places if ordered))


def part_of(rows: DataFrame, cuts: list[tuple], cursor: str, tie: str | None = None) -> Column:
    """The number of the part that a row of ``rows`` falls into, from 0; rows without a cursor are in part 0."""
    columns = [cursor, *([tie] if tie else [])]
    place = F.struct(*columns)

    def at(cut: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for v, c in zip(cut, columns)])

    return sum([(place >= at(cut)).cast("int") for cut in cuts], F.lit(0))


def even_predicates(cuts: list[tuple], cursor: str, tie: str | None = None) -> list[str]:
    """A condition per part as SQL text for a database reader; together they hold for every row once."""
    if not cuts:
        return ["1 = 1"]

    def below(cut: tuple) -> str:
        value = _literal_of(cut[0])
        if len(cut) == 1:
            return f"{cursor} < {value}"
        return f"({cursor} < {value} OR ({cursor} = {value} AND ({tie} IS NULL OR {tie} < {_literal_of(cut[1])})))"

    first = [f"({below(cuts[0])} OR {cursor} IS NULL)"]
    middle = [f"(NOT {below(a)} AND {below(b)})" for a, b in zip(cuts, cuts[1:])]
    return [*first, *middle, f"NOT {below(cuts[-1])}"]


def _literal_of(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ', timespec='microseconds')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def read_evenly(spark: SparkSession, url: str, table: str, cuts: list[tuple], cursor: str, tie: str | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table read in parts of even size: one query per part of ``cuts``, which an earlier landed pull gives."""
    return spark.read.jdbc(url, table, predicates=even_predicates(cuts, cursor, tie), properties=properties or {})


def jdbc_reader(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    properties: dict[str, str] | None = None,
    partitions: int = 16,
    fetch_size: int = 10_000,
) -> Callable[[], DataFrame]:
    """A reader of a database table for :func:`pull_by_cursor`, with ``partitions`` parallel reads.

    ``partition_column`` is numeric, date or timestamp, for example the cursor. Its range over the rows
    to pull is asked from the database at each read, so a pull of a few recent rows is cut into as many
    reads as the first one. The range only places the cuts, so no row is left out.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")

    def source() -> DataFrameReader:
        return spark.read.format("jdbc").options(**(properties or {})).option("url", url)

    def read(cursor: str | None = None, last_value: str | None = None) -> DataFrame:
        whole = source().option("dbtable", table).option("fetchsize", fetch_size)
        asked = f"SELECT MIN({partition_column}) AS low, MAX({partition_column}) AS high FROM {table}"
        if cursor and last_value is not None:
            asked += f" WHERE {cursor} >= {_literal(last_value)}"
        found = source().option("query", asked).load()
        found = found.select(*[_bound(found, name) for name in found.columns]).first()
        if found[0] is None or partitions == 1:
            return whole.load()
        return (
            whole.option("partitionColumn", partition_column)
            .option("lowerBound", found[0])
            .option("upperBound", found[1])
            .option("numPartitions", partitions)
            .load()
        )

    return read


def _literal(text: str) -> str:
    """A cursor value as SQL text; instants in UTC."""
    if _MICROS.fullmatch(text):
        moment = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=int(text.split()[0]))
        return f"TIMESTAMP '{moment.strftime('%Y-%m-%d %H:%M:%S.%f')}+00:00'"
    return text if re.fullmatch(r"-?\d+(\.\d+)?", text) else "'" + text.replace("'", "''") + "'"


def _bound(found: DataFrame, name: str) -> Column:
    """A bound as the text the reader takes: whole numbers, dates or timestamps."""
    column = F.col(name)
    if isinstance(found.schema[name].dataType, T.NumericType):
        column = column.cast("bigint")
    return column.cast("string")
