"""Payloads in a registry envelope: magic byte, four-byte schema id, body.

The envelope is split with built-in expressions. Bodies are decoded by Spark's own functions: ``from_json``
for JSON payloads, whose schemas are Spark schemas as JSON; ``from_avro`` for Avro payloads, which needs
Spark's Avro package on the class path.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("FAILFAST", "PERMISSIVE")
FORMATS = ("avro", "json")
_CORRUPT = "__corrupt"
_PARSED = "__parsed"


def split_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``magic``, ``schema_id`` and ``body``; all NULL where the value is NULL.

    A value too short for the envelope has an empty ``body``; it and one whose id is not a
    positive integer have no ``schema_id``.
    """
    raw = F.col(value)
    schema_id = F.conv(F.hex(F.substring(raw, 2, 4)), 16, 10).try_cast("int")
    return df.select(
        "*",
        F.conv(F.hex(F.substring(raw, 1, 1)), 16, 10).cast("int").alias("magic"),
        F.when(F.length(raw) >= 5, schema_id).alias("schema_id"),
        F.expr(f"substring(`{value}`, 6)").alias("body"),
    )


def has_unknown_schema(schemas: dict[int, str]) -> Column:
    """Whether an envelope is sound and names a schema that is not among ``schemas``; never NULL."""
    return _sound() & ~F.col("schema_id").isin(list(schemas))


def _sound() -> Column:
    return F.coalesce((F.col("magic") == 0) & F.col("schema_id").isNotNull(), F.lit(False))


def payload_names(schema_text: str) -> list[str]:
    """The fields of a payload schema, of either format."""
    schema = json.loads(schema_text)
    if schema.get("type") not in ("record", "struct"):
        raise ValueError("the payload schema must be a record")
    return [field["name"] for field in schema["fields"]]


def decode_payload(
    df: DataFrame, schemas: dict[int, str], mode: str = "FAILFAST", payload_format: str = "avro", event: str = "event"
) -> DataFrame:
    """Add the struct ``event``, decoded from ``body`` with the schema ``schema_id`` names.

    ``schemas`` are the versions of one subject; the newest id gives the columns, and older payloads have
    NULL in columns they lack (an added Avro field needs a default). ``FAILFAST`` fails the task on a body
    that does not decode, ``PERMISSIVE`` gives NULL. An id outside ``schemas`` fails in both modes, before
    anything is committed: run again with the reloaded schema table.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}: use one of {', '.join(MODES)}")
    if payload_format not in FORMATS:
        raise ValueError(f"unknown format {payload_format!r}: use one of {', '.join(FORMATS)}")
    if not schemas:
        raise ValueError("no schema is registered for the subject")
    sound, unknown = _sound(), has_unknown_schema(schemas)
    refused = F.raise_error(F.concat(F.lit("unknown schema id "), F.col("schema_id").cast("string")))
    if payload_format == "json":
        # A column of its own, below the conditions that look at it, so that a body is parsed once.
        df = df.withColumn(_PARSED, _parsed(schemas, mode))
        decoded = _from_json(schemas)
    else:
        decoded = _from_avro(schemas, mode)
    result = F.when(unknown, refused).when(sound, decoded)
    if mode == "FAILFAST":
        df = df.withColumn(event, result)
        wrong = F.col("body").isNotNull() & F.col(event).isNull()
        failed = F.raise_error(F.concat(F.lit("payload does not decode, schema id "), F.coalesce(F.col("schema_id").cast("string"), F.lit("none"))))
        return df.withColumn(event, F.when(wrong, failed).otherwise(F.col(event))).drop(_PARSED)
    return df.withColumn(event, result).drop(_PARSED)


def _parsed(schemas: dict[int, str], mode: str) -> Column:
    reader = T.StructType.fromJson(json.loads(schemas[max(schemas)]))
    holder = T.StructType([*reader.fields, T.StructField(_CORRUPT, T.StringType())])
    # Only bodies of a sound envelope with a known id are parsed; the others are settled without.
    known = (F.col("magic") == 0) & F.col("schema_id").isin(list(schemas))
    body = F.when(known, F.col("body").cast("string"))
    return F.from_json(body, holder, {"mode": mode, "columnNameOfCorruptRecord": _CORRUPT})


def _from_json(schemas: dict[int, str]) -> Column:
    names = T.StructType.fromJson(json.loads(schemas[max(schemas)])).names
    parsed = F.col(_PARSED)
    return F.when(parsed.isNotNull() & parsed[_CORRUPT].isNull(), F.struct(*[parsed[n].alias(n) for n in names]))


def _from_avro(schemas: dict[int, str], mode: str) -> Column:
    from pyspark.sql.avro.functions import from_avro

    reader = schemas[max(schemas)]
    names = payload_names(reader)

    def version(schema_id: int) -> Column:
        decoded = from_avro(F.col("body"), schemas[schema_id], {"mode": mode, "avroSchema": reader})
        # A body that does not decode gives a struct of NULLs in PERMISSIVE mode.
        found = reduce(Column.__or__, [decoded[n].isNotNull() for n in names])
        return F.when((F.col("schema_id") == schema_id) & found, decoded)

    return F.coalesce(*[version(i) for i in schemas])
