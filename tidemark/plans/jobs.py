"""User-level jobs composed from sources, operators and sinks."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.payloads import decode_payload, has_unknown_schema, payload_names, split_envelope
from tidemark.operators.cdc import ChangeRules
from tidemark.operators.quality import expect
from tidemark.operators.views import CUSTOMER_EXPECTATIONS, customer_current, loan_current, loan_history
from tidemark.sources.csv_lots import RESCUED
from tidemark.sources.cursor import cursor_text, pull_by_cursor
from tidemark.sources.topics import METADATA_COLUMNS, default_subject, metadata_columns, subject_schemas
from tidemark.streaming.change_targets import ChangeTarget, merge_into
from tidemark.streaming.files import MAX_FILES, change_feed_columns, ingest_files
from tidemark.streaming.sinks import append_audited, append_stream, for_each_batch, safe_name
from tidemark.streaming.tables import AuditedTable, NamedView, found_or_none, write_line

# Columns and rules of the product feed.
PRODUCT_FEED = (
    T.StructType()
    .add("codigo", "string")
    .add("descripcion", "string")
    .add("operation", "string")
    .add("event_ts", "timestamp")
)
PRODUCT_RULES = ChangeRules(
    keys=["codigo"],
    sequence_by="event_ts",
    apply_as_deletes="operation = 'DELETE'",
    except_columns=["_source_metadata", "operation", "event_ts", "_ingested_at"],
)
PRODUCT_COMMENTS = ("Products as they are", "Products as they were, by version")
# Primary key and SCD type of the four core tables, and the cursor column of all.
CORE_TABLES = {
    "cliente": ("cliente_id", 2),
    "cuenta": ("cuenta_id", 1),
    "prestamo": ("prestamo_id", 2),
    "cuota": ("cuota_id", 1),
}
CORE_CURSOR = "fec_modificacion"


def decode_topic(
    messages: DataFrame,
    schemas: dict[int, str],
    environment: str,
    key_alias: str = "kafka_key",
    mode: str = "FAILFAST",
    keep_undecoded: bool = False,
    payload_format: str = "avro",
) -> DataFrame:
    """Payload fields, topic metadata, key as text, ingest time and environment.

    ``keep_undecoded`` adds ``undecoded``: the raw value of a message that did not decode.
    """
    own = [*METADATA_COLUMNS, key_alias, "ingested_at", "source_environment"]
    clashes = sorted(set(own) & set(payload_names(schemas[max(schemas)])))
    if clashes:
        raise ValueError(f"payload fields {', '.join(clashes)} have the names of metadata columns")
    envelope = split_envelope(messages.select(*metadata_columns(key_alias), "value"))
    events = decode_payload(envelope, schemas, mode, payload_format)
    undecoded = F.when(F.col("event").isNull(), F.col("value")).alias("undecoded")
    return (
        events.select("event.*", *METADATA_COLUMNS, key_alias, *([undecoded] if keep_undecoded else []))
        .withColumn("ingested_at", F.current_timestamp())
        .withColumn("source_environment", F.lit(environment))
    )


def ingest_topic(
    messages: DataFrame,
    registry: DataFrame,
    topic: str,
    environment: str,
    checkpoint_base: str,
    target: str | None = None,
    path: str | None = None,
    subject: str | None = None,
    key_alias: str = "kafka_key",
    mode: str = "FAILFAST",
    trigger: str = "available_now",
    interval: str | None = None,
    name: str | None = None,
    output_mode: str = "append",
    payload_format: str = "avro",
    checkpoint: str | None = None,
    merge_columns: bool = True,
    dead_letters: str | None = None,
) -> StreamingQuery:
    """Decode one topic into a bronze table; every topic has a query and a checkpoint of its own.

    Writes to the catalog table ``target`` (``path`` places its files), or with ``path`` alone to
    an audited table, which also takes up new payload fields. The schemas are read once, when the
    job starts: a message with an unknown schema id fails its batch, and the next run reloads them.
    ``checkpoint`` overrides the folder below ``checkpoint_base``. Without ``merge_columns`` payload
    fields that the catalog table lacks are an error. With ``dead_letters``, a path, messages with an unknown schema
    id do not fail the batch but are kept there as they came, for :func:`replay_dead_letters`.
    """
    if not topic or not environment:
        raise ValueError("topic and environment are required")
    if not target and not path:
        raise ValueError("a target table or a path is required")
    if not target and output_mode != "append":
        raise ValueError("an audited table can only be appended to")
    if dead_letters and target:
        raise ValueError("dead letters are kept beside an audited table: give a path and no target")
    schemas = subject_schemas(registry, subject or default_subject(topic))
    checkpoint = checkpoint or f"{checkpoint_base.rstrip('/')}/{safe_name(topic)}"
    name = name or f"bronze_{safe_name(topic)}_kafka"

    def decoded(rows: DataFrame) -> DataFrame:
        return decode_topic(rows, schemas, environment, key_alias, mode, mode == "PERMISSIVE", payload_format)

    if target:
        return append_stream(decoded(messages), target, checkpoint, trigger, interval, name, output_mode, path, merge_columns)
    if not dead_letters:
        return append_audited(decoded(messages), path, checkpoint, trigger, interval, name)
    bronze, dead = AuditedTable(messages.sparkSession, path), AuditedTable(messages.sparkSession, dead_letters)

    def write(batch: DataFrame, writer: str, number: int) -> None:
        unknown = split_envelope(batch).where(has_unknown_schema(schemas)).select(*batch.columns, "schema_id")
        dead.append(unknown, writer, number, "DEAD LETTER")
        sound = split_envelope(batch).where(~has_unknown_schema(schemas)).select(*batch.columns)
        bronze.append(decoded(sound), writer, number, "STREAMING UPDATE")

    return for_each_batch(messages, write, checkpoint, trigger, interval, name)


def replay_dead_letters(
    registry: DataFrame,
    topic: str,
    environment: str,
    path: str,
    dead_letters: str,
    subject: str | None = None,
    key_alias: str = "kafka_key",
    mode: str = "FAILFAST",
    payload_format: str = "avro",
) -> int:
    """Decode the dead letters whose schema the reloaded registry knows into the bronze table; returns how many.

    Messages that are in the bronze table already, by topic, partition and offset, are left alone, so a replay may
    be repeated at any time.
    """
    spark = registry.sparkSession
    bronze, dead = AuditedTable(spark, path), AuditedTable(spark, dead_letters)
    schemas = subject_schemas(registry, subject or default_subject(topic))
    if dead.schema is None:
        return 0
    place = {"kafka_topic": "topic", "kafka_partition": "partition", "kafka_offset": "offset"}
    known = dead.read().where(F.col("schema_id").isin(list(schemas))).drop("schema_id")
    if bronze.schema is not None:
        seen = bronze.read().select(*[F.col(name).alias(source) for name, source in place.items()])
        known = known.join(seen, list(place.values()), "left_anti")
    events = decode_topic(known, schemas, environment, key_alias, mode, mode == "PERMISSIVE", payload_format)
    number = sum(name.startswith("replay/") for name in bronze.parts)
    name = bronze.append(events, "replay", number, "REPLAY")
    return bronze.read_parts([name]).count()


def ingest_lots(
    spark: SparkSession,
    path: str,
    target: str,
    base: str,
    schema: T.StructType | None = None,
    rescued: str = RESCUED,
    max_files: int | None = MAX_FILES,
    **more,
) -> StreamingQuery:
    """Lots of CSV files into an audited table.

    Without ``schema`` the columns are inferred and evolve; with one, everything outside it is
    rescued. Checkpoint and schema log live apart below ``base``, which belongs to one job.
    """
    fixed = schema is not None
    return ingest_files(
        spark,
        path,
        target,
        checkpoint=f"{base}/checkpoint",
        schema=schema,
        evolution="rescue" if fixed else "add",
        schema_log=None if fixed else f"{base}/schema_log",
        rescued=rescued,
        max_files=max_files,
        **more,
    )


def product_dimension(
    spark: SparkSession,
    feed_path: str,
    base: str,
    schema: T.StructType = PRODUCT_FEED,
    rules: ChangeRules = PRODUCT_RULES,
    max_files: int | None = MAX_FILES,
    names: tuple[str, str] | None = None,
    comments: tuple[str, str] = PRODUCT_COMMENTS,
    **more,
) -> tuple[StreamingQuery, ChangeTarget, ChangeTarget]:
    """A CSV change feed into a bronze table, and from it the current and the historical table.

    One micro-batch appends its events and then applies them to both targets. What the schema has no
    place for stays in the bronze table's rescue column. ``names`` gives both targets a place in the catalog, with
    ``comments``.
    """
    rules = replace(rules, except_columns=[*rules.except_columns, RESCUED])
    named = names or (None, None)
    current = ChangeTarget(spark, f"{base}/current", rules, 1, name=named[0], comment=comments[0])
    history = ChangeTarget(spark, f"{base}/history", rules, 2, name=named[1], comment=comments[1])
    query = ingest_files(
        spark,
        feed_path,
        f"{base}/bronze",
        checkpoint=f"{base}/checkpoint",
        schema=schema,
        evolution="rescue",
        max_files=max_files,
        added=change_feed_columns(),
        then=lambda events, writer, number: merge_into(events, [current, history], writer, number),
        **more,
    )
    return query, current, history


_PULLS = "number int, cursor_value string, applied boolean"


def pull_into(target: ChangeTarget, read: Callable[[], DataFrame], cursor: str) -> ChangeTarget:
    """Pull what changed since the last pull and apply it to ``target``.

    The pulled rows are written first, so that the rows applied and the cursor value remembered
    come from the same read of the database. A pull that was written but not applied, because
    the job died in between, is applied before the next one is made.
    """
    spark = target.spark
    pulls = AuditedTable(spark, f"{target.path}/pulls")
    log = found_or_none(lambda: spark.read.schema(_PULLS).json(f"{target.path}/cursor/*"))
    last = log.orderBy(F.desc("number")).first() if log is not None else None
    if last and not last["applied"]:
        _apply_pull(target, pulls, last["number"], last["cursor_value"])
    number, reached = (last["number"] + 1, last["cursor_value"]) if last else (0, None)
    pulls.append(pull_by_cursor(read, cursor, reached), "pull", number, "PULL")
    landed = pulls.read_parts([f"pull/{number}"])
    reached = landed.agg(cursor_text(landed, cursor)).first()[0] or reached
    write_line(spark, f"{target.path}/cursor/{number}", {"number": number, "cursor_value": reached, "applied": False})
    _apply_pull(target, pulls, number, reached)
    return target


def _apply_pull(target: ChangeTarget, pulls: AuditedTable, number: int, reached: str | None) -> None:
    target.merge(pulls.read_parts([f"pull/{number}"]), "pull", number)
    write_line(target.spark, f"{target.path}/cursor/{number}", {"number": number, "cursor_value": reached, "applied": True})


class PullError(RuntimeError):
    """Some of the tables could not be pulled; ``failures`` has the error of each by name."""

    def __init__(self, failures: dict[str, BaseException]):
        super().__init__("; ".join(f"{name}: {str(error).splitlines()[0]}" for name, error in failures.items()))
        self.failures = failures


def core_tables(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    base: str,
    tables: dict | None = None,
    cursor: str = CORE_CURSOR,
    at_once: int = 4,
) -> dict[str, ChangeTarget]:
    """Pull the core tables by cursor: versions for SCD type 2, the latest row for type 1.

    ``read(name)`` gives the DataFrame of a source table. ``at_once`` tables are pulled at a time, each in a
    scheduler pool of its own (which shares the cluster evenly if ``spark.scheduler.mode`` is FAIR). A table that
    fails does not stop the others; all failures are raised together once the rest is done, and the next
    call pulls again what is missing.
    """
    chosen = tables or CORE_TABLES
    targets = {name: ChangeTarget(spark, f"{base}/{name}", ChangeRules([key], cursor), scd_type) for name, (key, scd_type) in chosen.items()}

    def pull(name: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"pull-{name}")
        spark.sparkContext.setJobDescription(f"pull {name}")
        pull_into(targets[name], lambda: read(name), cursor)

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(pull), name) for name in targets}
        failures = {name: error for name, job in running.items() if (error := job.exception())}
    if failures:
        raise PullError(failures) from next(iter(failures.values()))
    return targets


# What the silver views are, as comments of their tables.
SILVER_COMMENTS = {
    "m_cliente": "Current customers",
    "h_prestamo": "Loan versions with their product",
    "m_prestamo": "Current loans with their product",
}


def silver_views(
    core: dict[str, ChangeTarget], products: ChangeTarget, base: str, names: dict[str, str] | None = None, keep: int = 2
) -> dict[str, NamedView]:
    """Full refresh of the customer and loan views from the core tables and the product lookup.

    ``names`` gives views another catalog name than their own. Each refresh adds to the table ``expectations``
    below ``base`` how many customers met and failed the expectations, counted while the view is written.
    """
    spark = products.spark
    loans, lookup = core["prestamo"].read(), products.read()
    customers, seen = expect(customer_current(core["cliente"].read()), CUSTOMER_EXPECTATIONS)
    frames = {"m_cliente": customers, "h_prestamo": loan_history(loans, lookup), "m_prestamo": loan_current(loans, lookup)}
    views = {
        view: NamedView(spark, (names or {}).get(view, view), keep).refresh(df, SILVER_COMMENTS[view])
        for view, df in frames.items()
    }
    log = AuditedTable(spark, f"{base}/expectations")
    version = len(log.parts)
    rows = [(version, "m_cliente", rule, seen.get[f"{rule}_passed"], seen.get[f"{rule}_failed"]) for rule in CUSTOMER_EXPECTATIONS]
    log.append(spark.createDataFrame(rows, "refresh int, view_name string, rule string, passed long, failed long"), "m_cliente", version)
    return views
