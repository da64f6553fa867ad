"""Parquet tables written a batch at a time with an audit row per write, and named views over versioned tables."""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
_HISTORY_SCHEMA = (
    T.StructType()
    .add("writer", "string")
    .add("number", "long")
    .add("operation", "string")
    .add("parameters", _TEXT_MAP)
    .add("rows", "long")
    .add("started_at", "timestamp")
    .add("committed_at", "timestamp")
    .add("schema_json", "string")
)


def merge_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Old columns first, then columns seen for the first time; structs are merged field by field.

    A column whose type changed is an error.
    """
    new = new.toNullable()
    if old is None:
        return new
    fields = {f.name: f for f in old}
    for field in new:
        kind = fields[field.name].dataType if field.name in fields else field.dataType
        if isinstance(kind, T.StructType) and isinstance(field.dataType, T.StructType):
            kind = merge_schema(kind, field.dataType)
        elif kind != field.dataType:
            raise ValueError(
                f"column {field.name!r} is {kind.simpleString()} in the table "
                f"and {field.dataType.simpleString()} in the write"
            )
        fields[field.name] = T.StructField(field.name, kind, True)
    return T.StructType(list(fields.values()))


def found_or_none(read):
    """What ``read`` gives, or None where its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_line(spark: SparkSession, path: str, values: dict) -> None:
    """One JSON row in a folder of its own, in place of what was there."""
    line = spark.range(0, 1, 1, 1).select(F.lit(json.dumps(values, default=str)).alias("value"))
    line.write.mode("overwrite").text(path)


class AuditedTable:
    """Batches of rows below ``path``, one folder per writer and number.

    Writing a number again replaces its folder with the same rows, so a replayed micro-batch changes nothing, and
    writers of different names never meet. A reader takes every folder. The audit row of a write (what, when, how
    many rows) is written after it and read by :meth:`history`; it decides nothing but the table's columns.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._schema: T.StructType | None = None

    def _rows(self) -> DataFrame | None:
        return found_or_none(lambda: self.spark.read.schema(_HISTORY_SCHEMA).json(f"{self.path}/history/*/*"))

    def refresh(self) -> "AuditedTable":
        """Forget the columns seen so far, to see writes made elsewhere."""
        self._schema = None
        return self

    @property
    def schema(self) -> T.StructType | None:
        """The columns of all writes, in the order they were first seen."""
        if self._schema is None and (rows := self._rows()) is not None:
            first = rows.groupBy("schema_json").agg(F.min(F.struct("committed_at", "writer", "number")).alias("at")).orderBy("at")
            for row in first.collect():
                self._schema = merge_schema(self._schema, T.StructType.fromJson(json.loads(row["schema_json"])))
        return self._schema

    @property
    def parts(self) -> list[str]:
        """Names of the audited writes, oldest first."""
        rows = self._rows()
        if rows is None:
            return []
        return [f"{r['writer']}/{r['number']}" for r in rows.orderBy("committed_at", "writer", "number").collect()]

    # -- reads ---------------------------------------------------------------------------

    def read(self) -> DataFrame:
        if self.schema is None:
            raise ValueError(f"table {self.path} has not been written")
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/*/*")

    def read_parts(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{n}" for n in names])

    def history(self) -> DataFrame:
        """One row per write, oldest first: version, timestamp, operation, operation_parameters, rows."""
        rows = self._rows()
        if rows is None:
            raise ValueError(f"table {self.path} has not been written")
        place = F.row_number().over(Window.orderBy("committed_at", "writer", "number")) - 1
        return rows.select(
            place.alias("version"),
            F.col("committed_at").alias("timestamp"),
            "operation",
            F.col("parameters").alias("operation_parameters"),
            "rows",
        )

    # -- writes --------------------------------------------------------------------------

    def append(
        self,
        df: DataFrame,
        writer: str,
        number: int,
        operation: str = "APPEND",
        parameters: dict[str, str] | None = None,
    ) -> str:
        """Add ``df`` as write ``number`` of ``writer``, in place of an earlier try of it; returns the write's name."""
        name, started = f"{writer}/{number}", datetime.now(timezone.utc)
        schema = merge_schema(self.schema, df.schema)
        df.write.mode("overwrite").parquet(f"{self.path}/data/{name}")
        # Parquet footers know how many rows there are.
        rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/data/{name}").count()
        entry = {
            "writer": writer,
            "number": number,
            "operation": operation,
            "parameters": {k: str(v) for k, v in (parameters or {}).items()},
            "rows": rows,
            "started_at": started.isoformat(),
            "committed_at": datetime.now(timezone.utc).isoformat(),
            "schema_json": df.schema.toNullable().json(),
        }
        write_line(self.spark, f"{self.path}/history/{name}", entry)
        self._schema = schema
        return name


class NamedView:
    """A catalog view over tables of full refreshes.

    A refresh writes a managed table of its own, switches the view to it in one statement, and drops tables
    older than the last ``keep``. A reader finds the old table or the new one, and a query that has begun can end as
    long as fewer than ``keep`` refreshes pass.
    """

    def __init__(self, spark: SparkSession, name: str, keep: int = 2):
        if keep < 1:
            raise ValueError("keep must be at least 1")
        self.spark, self.name, self.keep = spark, name, keep

    def versions(self) -> list[str]:
        """Names of the tables kept, oldest first."""
        database, _, own = self.name.rpartition(".")
        found = self.spark.catalog.listTables(database or None, f"{own}__v*")
        numbered = {t.name: int(m[1]) for t in found if (m := re.fullmatch(re.escape(own.lower()) + r"__v(\d+)_\w+", t.name.lower()))}
        return [f"{database}.{n}" if database else n for n in sorted(numbered, key=numbered.__getitem__)]

    def refresh(self, df: DataFrame, comment: str | None = None, properties: dict[str, str] | None = None) -> "NamedView":
        """Make ``df`` the content; it may read this very view."""
        kept = self.versions()
        number = int(re.search(r"__v(\d+)_\w+$", kept[-1])[1]) + 1 if kept else 0
        table = f"{self.name}__v{number}_{uuid.uuid4().hex[:8]}"
        df.write.format("parquet").saveAsTable(table)
        define_view(self.spark, self.name, f"SELECT * FROM {table}", comment, properties)
        for old in [*kept, table][: -self.keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


def define_view(
    spark: SparkSession, name: str, query: str, comment: str | None = None, properties: dict[str, str] | None = None
) -> None:
    """Make ``name`` a view of ``query``. An existing view is altered, as replacing it would drop it first and
    readers in between would find none."""
    about = {**(properties or {}), **({"comment": comment} if comment is not None else {})}
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER VIEW {name} AS {query}")
    else:
        spark.sql(f"CREATE VIEW {name} AS {query}")
    if about:
        spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ({', '.join(f'{quoted(k)} = {quoted(v)}' for k, v in about.items())})")


def refresh_view(df: DataFrame, name: str, comment: str | None = None, keep: int = 2) -> NamedView:
    """Full refresh of a materialized view by its catalog name."""
    return NamedView(df.sparkSession, name, keep).refresh(df, comment)


def describe_table(
    spark: SparkSession, name: str, comment: str | None = None, properties: dict[str, str] | None = None
) -> None:
    """Set comment and properties of a catalog table, after the write that created it."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def quoted(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"
