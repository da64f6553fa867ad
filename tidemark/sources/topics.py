"""Event topics: reader options, the topic stream and its metadata columns, subject schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOPIC_SCHEMA = (
    T.StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
    .add("timestampType", "integer")
)
# Names of the topic metadata columns.
METADATA_COLUMNS = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "kafka_timestamp_type"]


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    security_protocol: str | None = None,
    sasl_mechanism: str | None = None,
    login_module: str = "org.apache.kafka.common.security.scram.ScramLoginModule",
    username: str | None = None,
    password: str | None = None,
    ca_certificate: str | None = None,
) -> dict[str, str]:
    """Options of the Kafka reader; credentials and the PEM certificate are passed in as text.

    A drain-and-stop run that starts at ``latest`` would find nothing to read; use ``earliest``.
    """
    if not bootstrap_servers or not topic:
        raise ValueError("bootstrap_servers and topic are required")
    if max_offsets_per_trigger is not None and max_offsets_per_trigger < 1:
        raise ValueError("max_offsets_per_trigger must be at least 1")
    # The option keys of the Kafka reader.
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true" if fail_on_data_loss else "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if security_protocol:
        options["kafka.security.protocol"] = security_protocol
    if sasl_mechanism:
        if username is None or password is None:
            raise ValueError("SASL needs username and password")
        options["kafka.sasl.mechanism"] = sasl_mechanism
        options["kafka.sasl.jaas.config"] = (
            f'{login_module} required username="{username}" password="{password}";'
        )
    if ca_certificate:
        options["kafka.ssl.truststore.type"] = "PEM"
        options["kafka.ssl.truststore.certificates"] = ca_certificate
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A stream with a topic's columns from parquet files, for exported topics and tests."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).parquet(path)


def metadata_columns(key_alias: str = "kafka_key") -> list[Column]:
    """Topic metadata as ``kafka_*`` columns and the message key as text."""
    sources = ["topic", "partition", "offset", "timestamp", "timestampType"]
    columns = [F.col(s).alias(name) for s, name in zip(sources, METADATA_COLUMNS)]
    return [*columns, F.col("key").cast("string").alias(key_alias)]


def default_subject(topic: str) -> str:
    return f"{topic}-value"


def subject_schemas(registry: DataFrame, subject: str) -> dict[int, str]:
    """Schema versions of one subject by id, from a table (subject, schema_id, schema_json)."""
    rows = registry.where(F.col("subject") == subject).select("schema_id", "schema_json").collect()
    if not rows:
        raise ValueError(f"no schema is registered for subject {subject!r}")
    return {row["schema_id"]: row["schema_json"] for row in rows}
