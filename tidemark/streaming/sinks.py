"""Triggers and streaming sinks."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.tables import AuditedTable


def trigger_options(kind: str, interval: str | None = None) -> dict:
    """Arguments for ``writeStream.trigger``: ``processing_time`` with an interval, or ``available_now``."""
    if kind == "available_now":
        return {"availableNow": True}
    if kind == "processing_time":
        if not interval:
            raise ValueError("trigger 'processing_time' needs an interval")
        return {"processingTime": interval}
    raise ValueError(f"unknown trigger {kind!r}: use 'processing_time' or 'available_now'")


def safe_name(text: str) -> str:
    """``text`` as an identifier: everything but letters, digits and underscore becomes ``_``."""
    return re.sub(r"\W", "_", text, flags=re.ASCII)


def append_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    trigger: str = "available_now",
    interval: str | None = None,
    name: str | None = None,
    output_mode: str = "append",
    path: str | None = None,
    merge_columns: bool = True,
) -> StreamingQuery:
    """Append a stream to the catalog table ``target``; each (job, target) needs its own checkpoint.

    The file sink commits each micro-batch once. ``path`` places the table's files. Columns the
    table does not have yet are added to it, and its older rows read NULL there; without ``merge_columns`` they are
    an error.
    """
    if merge_columns:
        add_missing_columns(df.sparkSession, target, df.schema)
    elif missing := missing_columns(df.sparkSession, target, df.schema):
        raise ValueError(f"table {target} has no column {', '.join(f.name for f in missing)}")
    writer = (
        df.writeStream.format("parquet")
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger, interval))
    )
    if name:
        writer = writer.queryName(name)
    if path:
        writer = writer.option("path", path)
    return writer.toTable(target)


def add_missing_columns(spark: SparkSession, target: str, schema: T.StructType) -> list[str]:
    """Add the columns of ``schema`` that an existing catalog table lacks; returns their names."""
    missing = missing_columns(spark, target, schema)
    if missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({columns})")
    return [f.name for f in missing]


def missing_columns(spark: SparkSession, target: str, schema: T.StructType) -> list[T.StructField]:
    """The fields of ``schema`` that an existing catalog table lacks."""
    if not spark.catalog.tableExists(target):
        return []
    present = set(spark.table(target).columns)
    return [f for f in schema if f.name not in present]


def append_audited(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = "available_now",
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to an audited table: new columns are merged and each write is logged."""
    table = AuditedTable(df.sparkSession, path)

    def write(batch: DataFrame, writer: str, number: int) -> None:
        table.append(batch, writer, number, "STREAMING UPDATE")

    return for_each_batch(df, write, checkpoint, trigger, interval, name)


def for_each_batch(
    df: DataFrame,
    apply: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    trigger: str = "available_now",
    interval: str | None = None,
    name: str | None = None,
    output_mode: str = "append",
    settings: dict[str, str] | None = None,
) -> StreamingQuery:
    """Run ``apply(batch, writer, number)`` per micro-batch.

    ``writer`` is the id Spark keeps in the checkpoint, so a new checkpoint is a new writer and a
    restarted one continues its numbering. ``settings`` are settings of the session for this query alone.
    """
    spark = df.sparkSession
    known: list[str] = []

    def run(batch: DataFrame, number: int) -> None:
        if not known:
            known.append(checkpoint_id(spark, checkpoint))
        apply(batch, known[0], number)

    writer = (
        df.writeStream.foreachBatch(run)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger, interval))
    )
    if name:
        writer = writer.queryName(name)
    with set_for(spark, settings or {}):
        return writer.start()


@contextmanager
def set_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """``settings`` of the session while a query starts: it copies them then, and they are put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The query id stored in a checkpoint."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(r["value"] for r in lines))["id"]


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for the end of the stream; its failure is raised here."""
    query.awaitTermination()
    return query
