"""CSV files bound to columns by name.

Spark's CSV reader binds a given schema by position. Lots whose files differ in column order or
carry additional columns are therefore read per header: files with one header form a group, each
group is read as strings in its own column order, and the declared columns are taken by name.
What has no place in the declared columns is kept as a JSON object in the rescue column: fields
of undeclared columns, texts that do not cast to the declared type, and the raw line of a row
whose field count does not fit its header.
"""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
MALFORMED = "_corrupt_record"
#: Files up to this size are read whole to find their headers.
SMALL_FILE = 1 << 20
FILES_PER_JOB = 100
HEADER_LINES = 100
#: Types that texts can have, narrowest first, with the form a text must have beside being castable.
_KINDS = {
    "int": r"^\s*[+-]?\d+\s*$",
    "bigint": r"^\s*[+-]?\d+\s*$",
    "double": r"[^dDfF]\s*$",
    "date": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "timestamp": r"^\d{4}-\d{1,2}-\d{1,2}[ T]",
    "boolean": r"^(?i)(true|false)$",
}
#: The form of all texts that cast to a double. A cast that fails is an exception inside Spark, which takes many
#: times as long as this test.
_DOUBLE = (
    r"^[\x00-\x20]*[+-]?(?i)(nan|inf(inity)?|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?|0x([0-9a-f]+\.?|[0-9a-f]*\.[0-9a-f]+)p[+-]?\d+[df]?)"
    r"[\x00-\x20]*$"
)

Headers = dict[tuple[str, ...], list[str]]


def literal_path(path: str) -> str:
    """``path`` with the glob characters escaped, so that it names exactly one file."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def first_lines(
    spark: SparkSession,
    paths: list[str],
    options: dict[str, str] | None = None,
    sizes: dict[str, int] | None = None,
) -> dict[str, str]:
    """The first line of each file that has one; of a large file no more than the beginning is read.

    A file is a partition of its own and a limit stops its scan after the first row, on the executors and by
    Spark's own reader, so any store will do. Files known to have at most ``SMALL_FILE`` bytes are read in one scan
    instead, as a limit takes some driver time per file. With quoted line feeds a header may take up to
    ``HEADER_LINES`` lines.
    """
    probe = spark.newSession()
    # A file is never split, and a scan of several files has a partition for each.
    probe.conf.set("spark.sql.files.openCostInBytes", str(1 << 40))
    probe.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    probe.conf.set("spark.sql.files.minPartitionNum", "1")
    # One job for all files of a union, where adaptive execution would start one for each.
    probe.conf.set("spark.sql.adaptive.enabled", "false")
    given = {k.lower(): v for k, v in (options or {}).items()}
    quote = given.get("quote", '"') if given.get("multiline", "false").lower() == "true" else ""
    lines = HEADER_LINES if quote else 1
    # Neither a separator nor a quote that a header could hold: a row is a line.
    whole = {**(options or {}), "header": "false", "sep": "\u0001", "quote": "", "multiLine": "false", "mode": "PERMISSIVE"}

    def scan(members: list[str]) -> DataFrame:
        rows = probe.read.options(**whole).schema("value string").csv([literal_path(p) for p in members])
        return rows.select(F.col("_metadata.file_path").alias("path"), F.coalesce("value", F.lit("")).alias("value"))

    small = [p for p in paths if (sizes or {}).get(p, SMALL_FILE + 1) <= SMALL_FILE]
    large = sorted(set(paths) - set(small))
    held: dict[str, list[str]] = {}
    if small:
        begin = F.slice(F.collect_list("value"), 1, lines) if quote else F.array(F.first("value"))
        for row in scan(small).groupBy("path").agg(begin.alias("lines")).collect():
            held[row["path"]] = row["lines"]
    for start in range(0, len(large), FILES_PER_JOB):
        few = [scan([p]).limit(lines) for p in large[start : start + FILES_PER_JOB]]
        for row in reduce(DataFrame.unionAll, few).collect():
            held.setdefault(row["path"], []).append(row["value"])
    found = {unquote(urlsplit(path).path): _header(begin, quote) for path, begin in held.items()}
    return {path: text for path, text in found.items() if text}


def _header(lines: list[str], quote: str) -> str:
    """The first line, with those that follow while a quote is open."""
    text = lines[0]
    for line in lines[1:]:
        if not quote or text.count(quote) % 2 == 0:
            break
        text += "\n" + line
    return text


def group_by_header(
    spark: SparkSession,
    paths: list[str],
    options: dict[str, str] | None = None,
    sizes: dict[str, int] | None = None,
) -> Headers:
    """Paths by header; files without a line are left out. The caller bounds the paths (files per micro-batch)
    and may know their sizes in bytes."""
    lines = first_lines(spark, paths, options, sizes) if paths else {}
    given = {k.lower(): v for k, v in (options or {}).items()}
    style = {"delimiter": given.get("sep", given.get("delimiter", ",")), "quotechar": given.get("quote", '"') or None}
    if style["quotechar"] is None:
        style["quoting"] = csv.QUOTE_NONE
    split: dict[str, tuple[str, ...]] = {}
    for line in set(lines.values()):
        names = next(csv.reader(line.removeprefix("\ufeff").splitlines(keepends=True), **style), [])
        split[line] = tuple(name or f"_c{i}" for i, name in enumerate(names))
    groups: Headers = {}
    for path in paths:
        names = split.get(lines.get(unquote(urlsplit(path).path)), ())
        if names:
            groups.setdefault(names, []).append(path)
    for names, members in groups.items():
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"repeated column {', '.join(repeated)} in the header of {members[0]}")
    return groups


def read_group(
    spark: SparkSession, header: tuple[str, ...], paths: list[str], options: dict[str, str] | None = None
) -> DataFrame:
    """One header group as strings; columns are named ``f0, f1, ...`` in file order."""
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(len(header))])
    return (
        spark.read.options(**(options or {}))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .schema(schema.add(MALFORMED, "string"))
        .csv([literal_path(p) for p in paths])
    )


def bind_columns(
    spark: SparkSession,
    groups: Headers,
    schema: T.StructType,
    rescued: str | None = RESCUED,
    added: dict[str, Column] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The declared columns of all groups by name, the rescue column, and the ``added`` columns."""

    def bind(header: tuple[str, ...], paths: list[str]) -> DataFrame:
        place = {name: F.col(f"f{i}") for i, name in enumerate(header)}
        declared = {f.name: f.dataType for f in schema}
        columns, spare = [], []
        for name, kind in declared.items():
            if name in place:
                columns.append(place[name].try_cast(kind).alias(name))
            else:
                columns.append(F.lit(None).cast(kind).alias(name))
        for name in header:
            raw = place[name]
            if name not in declared:
                spare.append(raw.alias(name))
            elif not isinstance(declared[name], T.StringType):
                failed = raw.isNotNull() & raw.try_cast(declared[name]).isNull()
                spare.append(F.when(failed, raw).alias(name))
        if rescued:
            spare.append(F.col(MALFORMED))
            columns.append(F.nullif(F.to_json(F.struct(*spare)), F.lit("{}")).alias(rescued))
        columns += [column.alias(name) for name, column in (added or {}).items()]
        return read_group(spark, header, paths, options).select(*columns)

    if not groups:
        fields = [*schema.fields, *([T.StructField(rescued, T.StringType())] if rescued else [])]
        return spark.createDataFrame([], T.StructType(fields))
    return reduce(DataFrame.unionByName, [bind(h, p) for h, p in groups.items()])


def has_type(text: Column, kind: str) -> Column:
    """Whether a text is of a type; only texts of its form are cast."""
    form = text.rlike(_KINDS[kind])
    if kind == "double":
        form = text.rlike(_DOUBLE) & form
    return form & text.try_cast(kind).isNotNull()


def infer_types(texts: DataFrame, names: list[str]) -> T.StructType:
    """The narrowest type that all values of each text column have, in one pass over these columns; text where they
    disagree, and where there is no value."""
    counts = [F.count(F.col(f"`{name}`")).alias(f"n{i}") for i, name in enumerate(names)]
    for i, name in enumerate(names):
        text = F.col(f"`{name}`")
        for kind in _KINDS:
            counts.append(F.count_if(has_type(text, kind)).alias(f"n{i}_{kind}"))
    found = texts.agg(*counts).first()
    fields = []
    for i, name in enumerate(names):
        fitting = [kind for kind in _KINDS if found[f"n{i}"] and found[f"n{i}_{kind}"] == found[f"n{i}"]]
        fields.append(T.StructField(name, T.DataType.fromDDL(fitting[0] if fitting else "string")))
    return T.StructType(fields)
