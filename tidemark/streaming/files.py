"""Incremental ingestion of CSV files: each file once, by-name binding, schema evolution, rescue."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.neighbours import written
from tidemark.sources.csv_lots import RESCUED, bind_columns, group_by_header, infer_types
from tidemark.streaming.sinks import for_each_batch
from tidemark.streaming.tables import AuditedTable

_FILES = (
    T.StructType().add("path", "string").add("modificationTime", "timestamp").add("length", "long").add("content", "binary")
)
#: Files per micro-batch unless said otherwise.
MAX_FILES = 10_000
EVOLUTION_MODES = ("add", "rescue", "none")


class SchemaLog:
    """Column names and types of an evolving table; a type is fixed once it is logged.

    Kept apart from the checkpoint, in one file per version.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def read(self) -> tuple[int, T.StructType]:
        """Last version and its schema; version -1 before the first entry."""
        entry = T.StructType().add("version", "integer").add("schema_json", "string")
        try:
            rows = self.spark.read.schema(entry).json(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return -1, T.StructType()
            raise
        last = rows.orderBy(F.desc("version")).limit(1).collect()
        if not last:
            return -1, T.StructType()
        return last[0]["version"], T.StructType.fromJson(json.loads(last[0]["schema_json"]))

    def extend(self, version: int, schema: T.StructType) -> None:
        text = json.dumps({"schema_json": schema.json()})
        line = self.spark.range(0, 1, 1, 1).select(F.lit(text).alias("value"))
        line.write.mode("overwrite").text(f"{self.path}/version={version}")


# The names of the technical columns in the two functions below.
def lot_columns() -> dict[str, Column]:
    """Ingest time and source file name, the technical columns of a lot table."""
    return {
        "_ingestion_timestamp": F.current_timestamp(),
        "_source_file": F.col("_metadata.file_name"),
    }


def change_feed_columns() -> dict[str, Column]:
    """Source file metadata and ingest time, the technical columns of a change feed."""
    return {"_source_metadata": F.col("_metadata"), "_ingested_at": F.current_timestamp()}


def ingest_files(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    evolution: str = "add",
    rescued: str | None = RESCUED,
    schema_log: str | None = None,
    max_files: int | None = MAX_FILES,
    max_bytes: str | None = None,
    added: dict[str, Column] | None = None,
    options: dict[str, str] | None = None,
    pattern: str = "*.csv",
    trigger: str = "available_now",
    interval: str | None = None,
    name: str | None = None,
    then: Callable[[DataFrame, str, int], None] | None = None,
) -> StreamingQuery:
    """Append new CSV files below ``path`` to the audited table ``target``.

    ``evolution``: ``add`` infers columns, adds new ones and logs their types in ``schema_log``;
    ``rescue`` keeps ``schema`` and puts everything else into the ``rescued`` column; ``none``
    keeps ``schema`` and drops everything else. ``then`` is called with the rows of each
    micro-batch as written, for work that must follow the append. ``max_files`` bounds the files of
    a micro-batch, whose paths and headers the driver holds; ``max_bytes`` (such as ``10g``) bounds their
    size instead, at least one file being taken. None for both takes all that are there.
    """
    if evolution not in EVOLUTION_MODES:
        raise ValueError(f"unknown evolution mode {evolution!r}: use one of {', '.join(EVOLUTION_MODES)}")
    if (evolution == "add") != (schema is None):
        raise ValueError("evolution 'add' infers the schema; the other modes need one")
    if evolution == "add" and not schema_log:
        raise ValueError("evolution 'add' needs a schema_log path")
    if schema_log and schema_log.rstrip("/") == checkpoint.rstrip("/"):
        raise ValueError("schema_log and checkpoint must be different paths")
    if max_files is not None and max_files < 1:
        raise ValueError("max_files must be at least 1")
    if max_bytes is not None and max_files == MAX_FILES:
        max_files = None
    if max_bytes is not None and max_files is not None:
        raise ValueError("max_files and max_bytes cannot both be given")
    table = AuditedTable(spark, target)
    log = SchemaLog(spark, schema_log) if schema_log else None
    extra = lot_columns() if added is None else added
    rescue_column = None if evolution == "none" else rescued
    own = {name.lower() for name in [*extra, rescue_column] if name}
    if schema is not None and (clash := sorted(n for n in schema.names if n.lower() in own)):
        raise ValueError(f"columns {', '.join(clash)} of the schema have the names of technical columns")

    # Discovery only: the contents are not in the scan's schema, and a batch is its paths.
    discovery = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True)
    if max_files is not None:
        discovery = discovery.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        discovery = discovery.option("maxBytesPerTrigger", max_bytes)
    files = discovery.option("pathGlobFilter", pattern).load(path).select("path", "length")

    def ingest(batch: DataFrame, writer: str, number: int) -> None:
        sizes = {row["path"]: row["length"] for row in batch.collect()}
        groups = group_by_header(spark, sorted(sizes), options, sizes)
        if not groups:
            return
        if log is None:
            rows = bind_columns(spark, groups, schema, rescue_column, extra, options)
        else:
            rows = _evolved(spark, log, groups, rescue_column, extra, options, own)
        details = {"files": len(sizes), "bytes": sum(sizes.values()), "headers": len(groups)}
        part = table.append(rows, writer, number, "STREAMING UPDATE", details)
        if then:
            then(table.read_parts([part]), writer, number)

    return for_each_batch(files, ingest, checkpoint, trigger, interval, name)


def _evolved(spark, log: SchemaLog, groups, rescued: str | None, extra, options, own: set[str]) -> DataFrame:
    """The rows of ``groups`` under the known columns and those that are new. Files with new columns are parsed once:
    the rows are written with the new columns as texts, which then give the types."""
    version, known = log.read()
    # Names that differ in case only are one column; the other spellings are rescued, and so is a
    # field with the name of a technical column.
    taken = {n.lower() for n in known.names} | own
    new = []
    for name in (n for header in groups for n in header):
        if name.lower() not in taken:
            taken.add(name.lower())
            new.append(name)
    if not new:
        return bind_columns(spark, groups, known, rescued, extra, options)
    texts = T.StructType([*known.fields, *[T.StructField(n, T.StringType()) for n in new]])
    staged = written(bind_columns(spark, groups, texts, rescued, extra, options), "lots")
    found = infer_types(staged, new)
    log.extend(version + 1, T.StructType([*known.fields, *found.fields]))
    kinds = {f.name: f.dataType for f in found}
    # All values of a new column cast to its type, so nothing is left to rescue.
    return staged.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in staged.columns])
