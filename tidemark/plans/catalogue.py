"""The registered queries, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.payloads import split_envelope
from tidemark.operators.cdc import ChangeRules, current_versions, scd1, scd2, split_rejects
from tidemark.operators.quality import expectation_metrics
from tidemark.operators.reports import (
    group_counts,
    lot_summary,
    rescued_rows,
    rescued_summary,
    table_profile,
)
from tidemark.operators.views import CUSTOMER_EXPECTATIONS, customer_current, loan_current, loan_history
from tidemark.plans import inputs
from tidemark.plans.inputs import EVENT_RULES, LOT_SCHEMA, table
from tidemark.plans.jobs import (
    PRODUCT_RULES,
    core_tables,
    decode_topic,
    ingest_lots,
    ingest_topic,
    product_dimension,
    pull_into,
    replay_dead_letters,
    silver_views,
)
from tidemark.sources.batch import file_inventory, read_csv, read_table
from tidemark.sources.cursor import even_cuts, part_of, pull_by_cursor
from tidemark.sources.offsets import check_offsets, offset_runs, resume_offsets
from tidemark.sources.topics import TOPIC_SCHEMA, metadata_columns, read_topic_files
from tidemark.streaming.audit import WriteAudit
from tidemark.streaming.change_targets import ChangeTarget, apply_changes, latest_by_key
from tidemark.streaming.sinks import append_stream, drain, for_each_batch
from tidemark.streaming.tables import AuditedTable, refresh_view
from tidemark.workspace import KEYED_STATE, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


# -- change data capture -----------------------------------------------------------------

_EVENT_POINTS = """
    select * from events
    qualify row_number() over (partition by user_id, ts order by event_id desc) = 1
"""
_SCD1_EVENTS = """
select * exclude (rn) from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events
) where rn = 1 and event_type is distinct from 'error'
"""
_SCD2_EVENTS = f"""
select * from (
    select *, ts as __START_AT, lead(ts) over (partition by user_id order by ts) as __END_AT
    from ({_EVENT_POINTS})
) where event_type is distinct from 'error'
"""


@query("scd1_current", f"select * exclude (props) from ({_SCD1_EVENTS})")
def scd1_current(spark, sf_dir):
    return scd1(table(spark, sf_dir, "events"), except_columns=["props"], **EVENT_RULES)


@query("scd2_history", _SCD2_EVENTS)
def scd2_history(spark, sf_dir):
    return scd2(table(spark, sf_dir, "events"), **EVENT_RULES)


@query("scd2_hot_keys", _SCD2_EVENTS)
def scd2_hot_keys(spark, sf_dir):
    """The same history with every busy user's timeline cut into segments."""
    return scd2(table(spark, sf_dir, "events"), hot_rows=40, **EVENT_RULES)


@query("scd2_text_sequence", f"select * replace (cast(__START_AT as varchar) as __START_AT, cast(__END_AT as varchar) as __END_AT) from ({_SCD2_EVENTS})")
def scd2_text_sequence(spark, sf_dir):
    """Segments of a sequence that is text; times of one format sort like their texts."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    versions = scd2(table(spark, sf_dir, "events").withColumn("at", text), hot_rows=40, **EVENT_RULES | {"sequence_by": "at"})
    short = [F.regexp_replace(c, r"\.?0+$", "").alias(c) for c in ("__START_AT", "__END_AT")]
    return versions.drop("at").select(*[c for c in versions.columns if c not in ("at", "__START_AT", "__END_AT")], *short)


_COLLAPSED = f"""
    with points as ({_EVENT_POINTS}),
    marked as (
        select *, event_type = 'error' as gone, value > 20 as large,
               row_number() over (partition by user_id order by ts) as n,
               lag(event_type = 'error') over (partition by user_id order by ts) as gone_before,
               lag(value > 20) over (partition by user_id order by ts) as large_before
        from points
    ),
    changed as (
        select * from marked
        where n = 1 or gone is distinct from gone_before or large is distinct from large_before
    )
    select user_id, large, __START_AT, __END_AT from (
        select user_id, large, gone, ts as __START_AT,
               lead(ts) over (partition by user_id order by ts) as __END_AT
        from changed
    ) where not gone
"""


def _collapsed(spark: SparkSession, sf_dir: str, **more) -> DataFrame:
    log = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type", (F.col("value") > 20).alias("large")
    )
    versions = scd2(log, collapse_unchanged=True, track=["large"], **EVENT_RULES, **more)
    return versions.select("user_id", "large", "__START_AT", "__END_AT")


@query("scd2_collapsed", _COLLAPSED)
def scd2_collapsed(spark, sf_dir):
    return _collapsed(spark, sf_dir)


@query("scd2_hot_collapsed", _COLLAPSED)
def scd2_hot_collapsed(spark, sf_dir):
    """Unchanged versions collapsed across the segments of busy users."""
    return _collapsed(spark, sf_dir, hot_rows=40)


@query("scd2_current", f"select * from ({_SCD2_EVENTS}) where __END_AT is null")
def scd2_current(spark, sf_dir):
    return current_versions(scd2_history(spark, sf_dir))


@query(
    "scd2_composite_key",
    """
    select l_suppkey, l_returnflag, l_linestatus, l_quantity, __START_AT, __END_AT from (
        select *, l_shipdate as __START_AT,
               lead(l_shipdate) over (partition by l_suppkey, l_returnflag order by l_shipdate) as __END_AT
        from (
            select * from lineitem qualify row_number() over (
                partition by l_suppkey, l_returnflag, l_shipdate order by l_orderkey desc, l_linenumber desc) = 1
        )
    ) where l_linestatus <> 'F' or l_linestatus is null
    """,
)
def scd2_composite_key(spark, sf_dir):
    """Two keys, many events on one sequence value, tie-breakers that are not kept."""
    log = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_shipdate", "l_orderkey", "l_linenumber"
    )
    return scd2(
        log,
        ["l_suppkey", "l_returnflag"],
        "l_shipdate",
        "l_linestatus = 'F'",
        ["l_shipdate", "l_orderkey", "l_linenumber"],
        ["l_orderkey", "l_linenumber"],
    )


@query(
    "change_rejects",
    """
    select reject_reason, count(*) as n, min(event_id) as first_event, max(event_id) as last_event from (
        select event_id, case when event_type = 'signup' then 'null sequence'
                              when value > 50 then 'null key' end as reject_reason
        from events
    ) where reject_reason is not null group by reject_reason
    """,
)
def change_rejects(spark, sf_dir):
    _, rejects = split_rejects(_unkeyed(table(spark, sf_dir, "events")), ["user_id"], "ts")
    return rejects.groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )


def _event_stream(spark: SparkSession, events: DataFrame, base: str) -> DataFrame:
    """Events as a stream of a few batches in an order unlike their time."""
    path = inputs.land_scrambled(events, f"{base}/landing", "event_id")
    files = inputs.share_of_files(spark, path, 3)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path).drop("__lot")


def _incremental(spark: SparkSession, sf_dir: str, scd_type: int) -> DataFrame:
    base = scratch_path(spark, f"scd{scd_type}")
    target = ChangeTarget(spark, f"{base}/target", ChangeRules(**EVENT_RULES), scd_type)
    drain(apply_changes(_event_stream(spark, table(spark, sf_dir, "events"), base), [target], f"{base}/checkpoint"))
    return target.read()


@query("scd1_incremental", _SCD1_EVENTS)
def scd1_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir, 1)


@query("scd2_incremental", _SCD2_EVENTS)
def scd2_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir, 2)


def _keyed_state(spark: SparkSession, sf_dir: str, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Current rows and rejects of a stream of events with one value of state per key."""
    base = scratch_path(spark, "scd1-state")
    emitted, read, rejects = latest_by_key(_event_stream(spark, changes, base), ChangeRules(**EVENT_RULES))
    target = AuditedTable(spark, f"{base}/emitted")
    drain(for_each_batch(emitted, target.append, f"{base}/checkpoint", output_mode="update", settings=KEYED_STATE))
    return read(target.read()), rejects(target.read())


@query("scd1_streaming", _SCD1_EVENTS)
def scd1_streaming(spark, sf_dir):
    """The latest row per key as streaming state; each batch writes the keys it changed."""
    return _keyed_state(spark, sf_dir, table(spark, sf_dir, "events"))[0]


def _unkeyed(events: DataFrame) -> DataFrame:
    """Sign-ups without a time, and large events without a user."""
    return events.withColumn("ts", F.when(F.col("event_type") != "signup", F.col("ts"))).withColumn(
        "user_id", F.when(F.col("value") <= 50, F.col("user_id"))
    )


@query(
    "stream_rejects",
    """
    select event_id, case when value <= 50 then cast(user_id as varchar) end as user_id, event_type, value,
           case when event_type = 'signup' then 'null sequence' else 'null key' end as reject_reason
    from events where event_type = 'signup' or value > 50
    """,
)
def stream_rejects(spark, sf_dir):
    """Events that a keyed stream could not apply."""
    _, rejects = _keyed_state(spark, sf_dir, _unkeyed(table(spark, sf_dir, "events")))
    return rejects.select("event_id", F.col("user_id").cast("string").alias("user_id"), "event_type", "value", "reject_reason")


_PRODUCTS = """
    select cast(user_id as varchar) as codigo, event_type || ' ' || event_id as descripcion,
           event_type = 'error' as gone, ts,
           row_number() over (partition by user_id order by ts desc) as rn,
           lead(ts) over (partition by user_id order by ts) as until
    from events
"""


def _product_feed(spark: SparkSession, sf_dir: str, base: str) -> str:
    feed = inputs.product_log(spark, sf_dir)
    return inputs.land_csv(feed.withColumn("event_ts", F.col("event_ts").cast("string")), f"{base}/feed")


def _product_job(spark: SparkSession, sf_dir: str) -> tuple[str, ChangeTarget, ChangeTarget]:
    base = scratch_path(spark, "product")
    path = _product_feed(spark, sf_dir, base)
    files = inputs.share_of_files(spark, path, 2)
    job, current, history = product_dimension(spark, path, f"{base}/dimension", max_files=files)
    drain(job)
    return f"{base}/dimension/bronze", current, history


@query("product_current", f"select codigo, descripcion from ({_PRODUCTS}) where rn = 1 and not gone")
def product_current(spark, sf_dir):
    return _product_job(spark, sf_dir)[1].read()


@query(
    "product_history",
    f"select codigo, descripcion, ts as __START_AT, until as __END_AT from ({_PRODUCTS}) where not gone",
)
def product_history(spark, sf_dir):
    versions = _product_job(spark, sf_dir)[2].read()
    bounds = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("__START_AT", "__END_AT")]
    return versions.select("codigo", "descripcion", *bounds)


@query(
    "change_feed_bronze",
    """
    select cast(user_id as varchar) as codigo, event_type || ' ' || event_id as descripcion,
           case when event_type = 'error' then 'DELETE' else 'UPDATE' end as operation,
           ts as event_ts, true as has_ingest_time, true as has_file_name
    from events
    """,
)
def change_feed_bronze(spark, sf_dir):
    bronze, _, _ = _product_job(spark, sf_dir)
    return AuditedTable(spark, bronze).read().select(
        "codigo",
        "descripcion",
        "operation",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
        F.col("_ingested_at").isNotNull().alias("has_ingest_time"),
        F.col("_source_metadata.file_name").endswith(".csv").alias("has_file_name"),
    )


# -- cursor pulls ------------------------------------------------------------------------

_PULL_AT = "1997-01-01 00:00:00"
_LOAN_RULES = ChangeRules(["o_custkey"], "o_orderdate", tie_breakers=["o_orderkey"])


@query("cursor_pull", f"select * from orders where o_orderdate >= timestamp '{_PULL_AT}'")
def cursor_pull(spark, sf_dir):
    return pull_by_cursor(lambda: table(spark, sf_dir, "orders"), "o_orderdate", _PULL_AT)


def _two_pulls(spark: SparkSession, sf_dir: str, scd_type: int) -> DataFrame:
    """One pull while the table ends at a day, one when all of it is there."""
    orders = table(spark, sf_dir, "orders")
    early = orders.where(F.col("o_orderdate") <= F.lit(_PULL_AT).cast("timestamp_ntz"))
    target = ChangeTarget(spark, scratch_path(spark, f"pull{scd_type}"), _LOAN_RULES, scd_type)
    pull_into(target, lambda: early, "o_orderdate")
    return pull_into(target, lambda: orders, "o_orderdate").read()


@query(
    "cursor_scd1",
    "select * from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1",
)
def cursor_scd1(spark, sf_dir):
    return _two_pulls(spark, sf_dir, 1)


@query(
    "cursor_scd2",
    """
    select *, o_orderdate as __START_AT,
           lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as __END_AT
    from (
        select * from orders
        qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1
    )
    """,
)
def cursor_scd2(spark, sf_dir):
    return _two_pulls(spark, sf_dir, 2)


@query(
    "pull_splits",
    """
    select 16 as parts, true as even, count(*) as rows, count(distinct event_id) as events
    from events, (values (0), (1), (2)) as copies(c) where c = 0 or cast(ts as date) = date '2024-01-10'
    """,
)
def pull_splits(spark, sf_dir):
    """Sixteen parts of events of which one day has three times its share, cut where the rows are."""
    events = table(spark, sf_dir, "events")
    hot = F.when(F.col("ts").cast("date") == F.lit("2024-01-10").cast("date"), F.sequence(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    rows = events.select("*", F.explode(hot).alias("copy")).withColumn("id", F.col("event_id") * 3 + F.col("copy"))
    cuts = even_cuts(rows, "ts", 16, "id")
    sizes = rows.groupBy(part_of(rows, cuts, "ts", "id").alias("part")).agg(F.count("*").alias("n"))
    report = sizes.agg(F.count("*").cast("int").alias("parts"), (F.max("n") < 2 * F.avg("n")).alias("even"), F.sum("n").alias("rows"))
    return report.withColumn("events", F.lit(events.select("event_id").distinct().count()).cast("long"))


# -- silver views ------------------------------------------------------------------------

_LOANS = """
    select o_custkey as prestamo_id, o_custkey as cliente_id, cast(o_custkey as varchar) as producto_codigo,
           o_orderstatus as estado_prestamo_codigo, o_totalprice as monto_original,
           o_totalprice / 1000 as tasa_anual, cast(length(o_orderpriority) as integer) as numero_cuotas,
           o_orderdate as fecha_desembolso, o_orderdate as fec_modificacion, o_orderdate as __START_AT,
           lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as __END_AT
    from (
        select * from orders
        qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1
    )
"""
_LOAN_COLUMNS = """
    prestamo_id, cliente_id, producto_codigo, descripcion as producto, estado_prestamo_codigo,
    monto_original, tasa_anual, numero_cuotas, fecha_desembolso, fec_modificacion
"""
_LOAN_JOIN = f"""
    from ({_LOANS}) p
    left join (select codigo, descripcion from ({_PRODUCTS}) where rn = 1 and not gone) prd
    on p.producto_codigo = prd.codigo
"""


def _view_name(spark: SparkSession, view: str) -> str:
    """A catalog name that no other run has."""
    return scratch_path(spark, view).rsplit("/", 1)[-1].replace("-", "_")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.loan_log(spark, sf_dir)
    return scd2(log, ["prestamo_id"], "fec_modificacion", except_columns=["orden"], tie_breakers=["orden"])


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product lookup as a written table, so that joins know its real size."""
    log = inputs.product_log(spark, sf_dir)
    lookup = scd1(log, ["codigo"], "event_ts", "operation = 'DELETE'", ["operation", "event_ts"])
    return refresh_view(lookup, _view_name(spark, "products")).read()


@query("loan_history", f"select {_LOAN_COLUMNS}, __START_AT, __END_AT {_LOAN_JOIN}")
def loan_history_view(spark, sf_dir):
    return loan_history(loans(spark, sf_dir), products(spark, sf_dir))


@query("loan_current", f"select {_LOAN_COLUMNS} {_LOAN_JOIN} where __END_AT is null")
def loan_current_view(spark, sf_dir):
    return loan_current(loans(spark, sf_dir), products(spark, sf_dir))


@query("silver_refresh", f"select {_LOAN_COLUMNS}, __START_AT, __END_AT {_LOAN_JOIN}")
def silver_refresh(spark, sf_dir):
    """The loan view from end to end: cursor pulls, product feed, full refresh of the view."""
    base = scratch_path(spark, "silver")
    log = inputs.loan_log(spark, sf_dir)
    rules = ChangeRules(["prestamo_id"], "fec_modificacion", except_columns=["orden"], tie_breakers=["orden"])
    target = ChangeTarget(spark, f"{base}/prestamo", rules, 2)
    for until in (_PULL_AT, "9999-12-31 00:00:00"):
        seen = log.where(F.col("fec_modificacion") <= F.lit(until).cast("timestamp_ntz"))
        pull_into(target, lambda seen=seen: seen, "fec_modificacion")
    lookup = _product_job(spark, sf_dir)[1].read()
    return refresh_view(loan_history(target.read(), lookup), _view_name(spark, "h_prestamo")).read()


_CORE_TIME = f"timestamp '{inputs.CORE_FIRST_PULL}'"


def _core_to_silver(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, str]]:
    """Two rounds of the four core pulls, each followed by a refresh of the three views; their catalog names."""
    base = scratch_path(spark, "core")
    names = {v: f"{v}_{base.rsplit('-', 1)[-1]}" for v in ("m_cliente", "h_prestamo", "m_prestamo")}
    products = ChangeTarget(spark, f"{base}/products", PRODUCT_RULES, 1)
    products.merge(inputs.product_log(spark, sf_dir), "feed", 0)
    for until in (inputs.CORE_FIRST_PULL, "9999-12-31 00:00:00"):
        seen = F.col("fec_modificacion") < F.lit(until).cast("timestamp_ntz")
        core = core_tables(spark, lambda name, seen=seen: inputs.core_table(spark, sf_dir, name).where(seen), f"{base}/core")
        silver_views(core, products, f"{base}/silver", names)
    return base, names


@query(
    "core_to_silver",
    f"""
    with loans as (
        select o_orderkey, o_orderstatus, o_orderdate, coalesce(descripcion, '-') as product from orders
        left join (select codigo, descripcion from ({_PRODUCTS}) where rn = 1 and not gone) on cast(o_custkey as varchar) = codigo
    )
    select 'm_cliente' as view_name, c_custkey as id, c_name || '|' || c_mktsegment || '|' || coalesce(nullif(c_mktsegment, 'BUILDING'), '-') as detail
    from customer
    union all select 'h_prestamo', o_orderkey, product || '|' || o_orderstatus || '|' || strftime(o_orderdate, '%Y-%m-%d') from loans
    union all select 'm_prestamo', o_orderkey, product from loans
    """,
)
def core_to_silver(spark, sf_dir):
    """From the core tables to the views, read by their names."""
    _, names = _core_to_silver(spark, sf_dir)
    product = F.coalesce("producto", F.lit("-"))
    since = F.date_format("__START_AT", "yyyy-MM-dd")
    details = {
        "m_cliente": ("cliente_id", F.concat_ws("|", "nombre", "apellido", F.coalesce("cod_tipodoc", F.lit("-")))),
        "h_prestamo": ("prestamo_id", F.concat_ws("|", product, "estado_prestamo_codigo", since)),
        "m_prestamo": ("prestamo_id", product),
    }
    views = [
        spark.table(names[v]).select(F.lit(v).alias("view_name"), F.col(key).alias("id"), detail.alias("detail"))
        for v, (key, detail) in details.items()
    ]
    return views[0].unionByName(views[1]).unionByName(views[2])


@query(
    "customer_expectation_log",
    f"""
    select cast(refresh as integer) as refresh, 'm_cliente' as view_name, 'tipdoc_no_nulo' as rule,
           count(*) filter (c_mktsegment <> 'BUILDING') as passed, count(*) filter (c_mktsegment = 'BUILDING') as failed
    from customer join (values (0), (1)) as r(refresh)
        on refresh = 1 or timestamp '1994-12-20' + to_days(cast(c_nationkey as integer)) < {_CORE_TIME}
    group by refresh
    """,
)
def customer_expectation_log(spark, sf_dir):
    """How many customers met the expectation at each refresh of their view."""
    base, _ = _core_to_silver(spark, sf_dir)
    return AuditedTable(spark, f"{base}/silver/expectations").read()


@query(
    "customer_current",
    """
    select c_custkey as cliente_id, nullif(c_mktsegment, 'BUILDING') as cod_tipodoc, c_name as nombre,
           c_mktsegment as apellido, c_nationkey as fec_nacimiento, c_acctbal as fec_alta_usuario
    from customer where not c_acctbal < 0
    """,
)
def customer_current_view(spark, sf_dir):
    return customer_current(inputs.customer_versions(spark, sf_dir))


@query(
    "expect_metrics",
    """
    select 'tipdoc_no_nulo' as rule, count(*) filter (c_mktsegment <> 'BUILDING') as passed,
           count(*) filter (c_mktsegment = 'BUILDING') as failed
    from customer where not c_acctbal < 0
    union all
    select 'alta_positiva', count(*) filter (c_acctbal > 100), count(*) filter (c_acctbal <= 100)
    from customer where not c_acctbal < 0
    """,
)
def expect_metrics(spark, sf_dir):
    rules = {**CUSTOMER_EXPECTATIONS, "alta_positiva": F.col("fec_alta_usuario") > 100}
    return expectation_metrics(customer_current_view(spark, sf_dir), rules)


@query("mv_passthrough", "select * from part")
def mv_passthrough(spark, sf_dir):
    view = refresh_view(table(spark, sf_dir, "part"), _view_name(spark, "part_view"))
    return view.read()


@query("param_table_name", "select * from part")
def param_table_name(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("part_by_name")
    return read_table(spark, "part_by_name")


# -- reports -----------------------------------------------------------------------------


@query("lot_counts", 'select o_orderstatus, count(*) as "count" from orders group by all')
def lot_counts(spark, sf_dir):
    return group_counts(table(spark, sf_dir, "orders"), "o_orderstatus")


@query(
    "lot_priority_counts",
    """
    select 'LOTE-' || o_orderstatus as lot_name,
           case when o_orderstatus <> 'F' then substring(o_orderpriority, 3, 20) end as ship_priority, count(*) as "count"
    from orders group by all
    """,
)
def lot_priority_counts(spark, sf_dir):
    """Rows per lot and value of a column that the first lot did not have."""
    target, _ = _evolving_lots(spark, sf_dir)
    return group_counts(target.read(), "lot_name", "ship_priority")


@query(
    "lot_summary",
    """
    select o_orderpriority, count(*) as total_ordenes, count(distinct o_custkey) as clientes_unicos,
           round(sum(o_totalprice), 2) as facturacion_total,
           cast(sum(case when o_orderstatus <> 'F' then 1 else 0 end) as bigint) as con_prioridad_envio
    from orders group by o_orderpriority
    """,
)
def lot_summary_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "prioridad_envio", F.nullif(F.col("o_orderstatus"), F.lit("F"))
    )
    return lot_summary(orders, "o_orderpriority", "o_custkey", "o_totalprice", "prioridad_envio")


@query(
    "table_profile",
    """
    select (select count(*) from orders) as row_count, 6 as column_count, position, column_name, column_type
    from (values (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'),
                 (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'),
                 (5, 'o_orderpriority', 'string')) as c(position, column_name, column_type)
    """,
)
def table_profile_report(spark, sf_dir):
    return table_profile(table(spark, sf_dir, "orders"))


# -- CSV lots ----------------------------------------------------------------------------

_LOT = """
    select 'ORD-' || o_orderkey as order_ref, 'LOTE-' || o_orderstatus as lot_name,
           cast(cast(o_orderdate as date) as varchar) as order_day, cast(o_custkey as varchar) as customer_ref,
           o_totalprice as line_total, o_orderstatus as order_state,
           case when not starts_with(o_orderpriority, '3') then cast(length(o_orderpriority) as integer) end
               as promised_days,
           case when starts_with(o_orderpriority, '3') then '"promised_days":"n/a"' end as bad_days,
           substring(o_orderpriority, 3, 20) as prioridad, 'valor ' || o_custkey as extra
    from orders
"""
_RESCUED = f"""
    select order_ref, lot_name, order_day, customer_ref, line_total, order_state, promised_days,
           case when parts <> '' then '{{' || parts || '}}' end as _rescued_data
    from (
        select *, case order_state
            when 'F' then coalesce(bad_days, '')
            when 'O' then concat_ws(',', bad_days, '"ship_priority":"' || prioridad || '"')
            else concat_ws(',', '"extra_remark":"' || extra || '"',
                           '"ship_priority":"' || prioridad || '"', bad_days) end as parts
        from ({_LOT})
    )
"""


def _evolving_lots(spark: SparkSession, sf_dir: str) -> tuple[AuditedTable, list[DataFrame]]:
    """Lot F, then lots O and P with new columns, then nothing new, by the same job; the counts per lot after each run."""
    base = scratch_path(spark, "lots")
    counts = []
    target = AuditedTable(spark, f"{base}/bronze")
    for n, status in enumerate(["F", "O", "P", None]):
        if status:
            inputs.land_csv(inputs.lot(spark, sf_dir, status), f"{base}/landing/lote{n + 1}")
        drain(ingest_lots(spark, f"{base}/landing", target.path, f"{base}/job"))
        counts.append(group_counts(target.refresh().read(), "lot_name"))
    return target, counts


@query(
    "csv_evolve_add_columns",
    f"""
    select order_ref, lot_name, order_day, cast(customer_ref as bigint) as customer_ref, line_total, order_state,
           case when bad_days is null then cast(promised_days as varchar) else 'n/a' end
               as promised_days,
           case when order_state <> 'F' then prioridad end as ship_priority,
           case when order_state = 'P' then extra end as extra_remark,
           cast(null as varchar) as _rescued_data, true as has_source_file
    from ({_LOT})
    """,
)
def csv_evolve_add_columns(spark, sf_dir):
    target, _ = _evolving_lots(spark, sf_dir)
    return target.read().select(
        "order_ref",
        "lot_name",
        F.col("order_day").cast("string").alias("order_day"),
        F.col("customer_ref").cast("bigint").alias("customer_ref"),
        "line_total",
        "order_state",
        "promised_days",
        "ship_priority",
        "extra_remark",
        "_rescued_data",
        F.col("_source_file").endswith(".csv").alias("has_source_file"),
    )


@query(
    "no_reprocess",
    """
    select 'LOTE-' || o_orderstatus as lot_name, count(*) filter (o_orderstatus = 'F') as after_1,
           count(*) filter (o_orderstatus in ('F', 'O')) as after_2, count(*) as after_3, count(*) as after_4
    from orders group by all
    """,
)
def no_reprocess(spark, sf_dir):
    """Rows per lot after each run; the fourth run finds nothing new."""
    _, counts = _evolving_lots(spark, sf_dir)
    found = counts[-1].select("lot_name")
    for n, run in enumerate(counts, 1):
        found = found.join(run.withColumnRenamed("count", f"after_{n}"), "lot_name", "left")
    return found.na.fill(0)


def _fixed_lots(spark: SparkSession, sf_dir: str, batches: int = 1) -> AuditedTable:
    """All three lots under the fixed schema."""
    base = scratch_path(spark, "quarantine")
    for n, status in enumerate(["F", "O", "P"]):
        inputs.land_csv(inputs.lot(spark, sf_dir, status), f"{base}/landing/lote{n + 1}")
    files = inputs.share_of_files(spark, f"{base}/landing", batches)
    drain(ingest_lots(spark, f"{base}/landing", f"{base}/bronze", f"{base}/job", LOT_SCHEMA, max_files=files))
    return AuditedTable(spark, f"{base}/bronze")


@query(
    "csv_rescue_fixed_schema",
    f"select * replace (cast(promised_days as double) as promised_days) from ({_RESCUED})",
)
def csv_rescue_fixed_schema(spark, sf_dir):
    lots = _fixed_lots(spark, sf_dir).read().drop("_ingestion_timestamp", "_source_file")
    return lots.withColumn("promised_days", F.col("promised_days").cast("double"))


@query(
    "rescued_rows",
    f"select order_ref, _rescued_data from ({_RESCUED}) where _rescued_data is not null",
)
def rescued_rows_report(spark, sf_dir):
    return rescued_rows(_fixed_lots(spark, sf_dir).read(), "order_ref")


@query(
    "rescued_summary",
    f"""
    select lot_name, count(*) as total_registros, count(_rescued_data) as con_rescued_data
    from ({_RESCUED}) group by lot_name
    """,
)
def rescued_summary_report(spark, sf_dir):
    return rescued_summary(_fixed_lots(spark, sf_dir).read(), "lot_name")


@query(
    "admission_control",
    """
    select 'LOTE-' || o_orderstatus as lot_name, count(*) as "count", true as several_batches, true as files_within, true as bytes_within
    from orders group by all
    """,
)
def admission_control(spark, sf_dir):
    """All lots by a job that takes half of the files at a time, and by one that takes half of their bytes."""
    base = scratch_path(spark, "admission")
    for n, status in enumerate(["F", "O", "P"]):
        inputs.land_csv(inputs.lot(spark, sf_dir, status), f"{base}/landing/lote{n + 1}")
    landed = file_inventory(spark, f"{base}/landing", "*.csv")
    total, largest, files = landed.agg(F.sum("length"), F.max("length"), F.count("*")).first()
    limits = {"files": max(1, files // 2), "bytes": max(1, total // 2)}
    counts, seen = [], {}
    for kind, limit in limits.items():
        admitted = {"max_files": limit} if kind == "files" else {"max_bytes": str(limit)}
        drain(ingest_lots(spark, f"{base}/landing", f"{base}/{kind}", f"{base}/job-{kind}", LOT_SCHEMA, **admitted))
        target = AuditedTable(spark, f"{base}/{kind}")
        greatest = F.max(F.col("operation_parameters")[kind].cast("long"))
        seen[kind] = target.history().agg(greatest, F.count("*"), F.sum(F.col("operation_parameters")[kind].cast("long"))).first()
        counts.append(group_counts(target.read(), "lot_name"))
    # A batch may pass the bytes by the file that it takes at least.
    within = {"files": seen["files"][0] <= limits["files"], "bytes": seen["bytes"][0] <= max(limits["bytes"], largest)}
    whole = seen["files"][2] == files and seen["bytes"][2] == total
    several = (files < 2 or seen["files"][1] > 1) and whole
    return (
        counts[0]
        .join(counts[1], ["lot_name", "count"])
        .withColumn("several_batches", F.lit(several))
        .withColumn("files_within", F.lit(within["files"]))
        .withColumn("bytes_within", F.lit(within["bytes"]))
    )


@query(
    "write_history",
    """
    select row_number() over (order by lot) - 1 as version, 'STREAMING UPDATE' as operation, '1' as headers, count(*) as rows,
           true as files_match, true as audited, true as in_order
    from (select o_orderstatus as lot from orders where o_orderstatus in ('F', 'O', 'P')) group by lot
    """,
)
def write_history(spark, sf_dir):
    """The writes of the lot job, beside the files that landed and what a listener noted of the micro-batches."""
    base = scratch_path(spark, "history")
    target, audit = AuditedTable(spark, f"{base}/bronze"), WriteAudit(spark, f"{base}/audit")
    files, noted = [], []
    with audit:
        for status in ("F", "O", "P"):
            path = inputs.land_csv(inputs.lot(spark, sf_dir, status), f"{base}/landing/{status}")
            job = drain(ingest_lots(spark, f"{base}/landing", target.path, f"{base}/job"))
            files.append(file_inventory(spark, path, "*.csv").count())
            noted.append(audit.wait_for(job))
    batches = noted[-1].select("batch_id", "input_rows", (F.col("ended_at") >= F.col("started_at")).alias("in_order"))
    landed = spark.createDataFrame(list(enumerate(files)), "version int, landed long")
    writes = target.history().select(
        F.col("version").cast("int").alias("version"),
        "operation",
        F.col("operation_parameters")["headers"].alias("headers"),
        "rows",
        F.col("operation_parameters")["files"].cast("long").alias("files"),
    )
    found = writes.join(landed, "version", "left").join(batches, F.col("version") == F.col("batch_id"), "left")
    return found.select(
        F.col("version").cast("long").alias("version"),
        "operation",
        "headers",
        "rows",
        (F.col("files") == F.col("landed")).alias("files_match"),
        (F.col("input_rows") == F.col("landed")).alias("audited"),
        "in_order",
    )


@query(
    "file_inventory",
    """
    select 'lote-' || o_orderstatus as lote, cast(sum(strlen(line) + 1) as bigint) as bytes, true as has_time
    from (
        select o_orderstatus, concat_ws(',', 'ORD-' || o_orderkey, 'LOTE-' || o_orderstatus, o_custkey) as line from orders
    ) group by o_orderstatus
    """,
)
def file_inventory_report(spark, sf_dir):
    """Bytes per folder of files without a header, whose lines the SQL can measure."""
    base = scratch_path(spark, "inventory")
    for status in ("F", "O", "P"):
        inputs.lot(spark, sf_dir, status).select("order_ref", "lot_name", "customer_ref").write.csv(f"{base}/lote-{status}")
    return (
        file_inventory(spark, base, "*.csv")
        .groupBy(F.element_at(F.split("path", "/"), -2).alias("lote"))
        .agg(F.sum("length").alias("bytes"), F.max("modificationTime").isNotNull().alias("has_time"))
    )


@query(
    "csv_batch_preview",
    f"""
    select order_ref, lot_name, order_day, customer_ref, line_total, order_state,
           coalesce(cast(promised_days as varchar), 'n/a') as promised_days,
           case when order_state <> 'F' then prioridad end as ship_priority,
           case when order_state = 'P' then extra end as extra_remark
    from ({_LOT})
    """,
)
def csv_batch_preview(spark, sf_dir):
    """Each lot read as it is; the columns that a lot lacks are NULL."""
    base = scratch_path(spark, "preview")
    lots = [read_csv(spark, inputs.land_csv(inputs.lot(spark, sf_dir, s), f"{base}/{s}")) for s in ("F", "O", "P")]
    every = lots[0].unionByName(lots[1], True).unionByName(lots[2], True)
    return every.withColumn("line_total", F.col("line_total").cast("double"))


@query(
    "csv_batch_headerless",
    """
    select cast(n_nationkey as varchar) as _c0, n_name as _c1, cast(n_regionkey as varchar) as _c2 from nation
    """,
)
def csv_batch_headerless(spark, sf_dir):
    path = scratch_path(spark, "headerless")
    table(spark, sf_dir, "nation").write.csv(path)
    return read_csv(spark, path, header=False)


# -- streams and topics ------------------------------------------------------------------


@query("stream_append", "select * from orders")
def stream_append(spark, sf_dir):
    base = scratch_path(spark, "append")
    name = base.rsplit("/", 1)[-1].replace("-", "_")
    inputs.land_scrambled(table(spark, sf_dir, "orders"), f"{base}/landing", "o_orderkey")
    schema = spark.read.parquet(f"{base}/landing").schema
    orders = spark.readStream.schema(schema).parquet(f"{base}/landing").drop("__lot")
    drain(append_stream(orders, name, f"{base}/checkpoint", name=name, path=f"{base}/table"))
    return spark.table(name)


def _landed_topic(spark: SparkSession, sf_dir: str, base: str, topic: str = "pagos") -> str:
    path = f"{base}/{topic}"
    columns = TOPIC_SCHEMA.names
    inputs.messages(spark, sf_dir, topic).select(*columns).write.parquet(path)
    return path


@query(
    "topic_envelope",
    """
    select 'pagos' as kafka_topic, cast(user_id % 4 as integer) as kafka_partition, event_id as kafka_offset,
           ts as kafka_timestamp, 0 as kafka_timestamp_type, cast(user_id as varchar) as user_key
    from events
    """,
)
def topic_envelope(spark, sf_dir):
    base = scratch_path(spark, "envelope")
    stream = read_topic_files(spark, _landed_topic(spark, sf_dir, base))
    events = stream.select(*metadata_columns("user_key"))
    target = AuditedTable(spark, f"{base}/bronze")
    drain(for_each_batch(events, target.append, f"{base}/checkpoint"))
    return target.read().withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))


@query(
    "envelope_schema_id",
    f"""
    select case when ts >= timestamp '{inputs.SCHEMA_CHANGE_AT}' then 2 else 1 end as schema_id,
           'pagos-value' as subject, 0 as magic, count(*) as n from events group by all
    """,
)
def envelope_schema_id(spark, sf_dir):
    split = split_envelope(inputs.messages(spark, sf_dir))
    known = inputs.registry(spark).select("subject", "schema_id")
    return split.groupBy("magic", "schema_id").agg(F.count(F.lit(1)).alias("n")).join(known, "schema_id")


_DECODED = f"""
    select 'EVT-' || event_id as event_ref, event_id, user_id, cast(cast(ts as date) as varchar) as event_day, value,
           event_type, date_trunc('millisecond', ts) as event_at,
           case when ts >= timestamp '{inputs.SCHEMA_CHANGE_AT}' then props end as props,
           event_id as kafka_offset, cast(user_id as varchar) as user_key, 'dev' as source_environment
    from events
"""


@query("topic_decode", _DECODED)
def topic_decode(spark, sf_dir):
    base = scratch_path(spark, "decode")
    stream = read_topic_files(spark, _landed_topic(spark, sf_dir, base))
    job = ingest_topic(
        stream, inputs.registry(spark), "pagos", "dev", f"{base}/checkpoints", path=f"{base}/bronze", key_alias="user_key", payload_format="json"
    )
    drain(job)
    return _decoded_columns(AuditedTable(spark, f"{base}/bronze").read())


def _decoded_columns(events: DataFrame, *more: str) -> DataFrame:
    return events.select(
        "event_ref", "event_id", "user_id", F.col("event_day").cast("string").alias("event_day"), "value", "event_type",
        F.col("event_at").cast("timestamp_ntz").alias("event_at"), "props", "kafka_offset", "user_key", "source_environment", *more,
    )


@query("topic_decode_batch", _DECODED)
def topic_decode_batch(spark, sf_dir):
    """The decoder on a bounded read of the topic."""
    events = decode_topic(inputs.messages(spark, sf_dir), inputs.payload_schemas(), "dev", "user_key", payload_format="json")
    return _decoded_columns(events)


@query(
    "topic_permissive",
    """
    select event_id as kafka_offset, event_id % 3 = 0 as undecoded, case when event_id % 3 <> 0 then 'EVT-' || event_id end as event_ref,
           case when event_id % 3 <> 0 then value end as value, case when event_id % 3 <> 0 then event_type end as event_type
    from events
    """,
)
def topic_permissive(spark, sf_dir):
    """Every third body is cut short: its event is NULL and its raw value is kept."""
    cut = F.when(F.col("offset") % 3 == 0, F.expr("substring(value, 1, 9)")).otherwise(F.col("value"))
    messages = inputs.messages(spark, sf_dir).withColumn("value", cut)
    events = decode_topic(
        messages, inputs.payload_schemas(), "dev", mode="PERMISSIVE", keep_undecoded=True, payload_format="json"
    )
    return events.select("kafka_offset", F.col("undecoded").isNotNull().alias("undecoded"), "event_ref", "value", "event_type")


@query(
    "topic_two_targets",
    """
    select topic as target, topic as kafka_topic, count(*) as n, count(distinct user_id) as users,
           min(event_id) as first_offset, max(event_id) as last_offset
    from events cross join (values ('pagos'), ('transacciones')) as t(topic) group by topic
    """,
)
def topic_two_targets(spark, sf_dir):
    """Two topics, one job definition, a table and a checkpoint each."""
    base = scratch_path(spark, "topics")
    reports = []
    for topic in ("pagos", "transacciones"):
        stream = read_topic_files(spark, _landed_topic(spark, sf_dir, base, topic))
        drain(ingest_topic(stream, inputs.registry(spark, topic), topic, "dev", f"{base}/checkpoints", path=f"{base}/bronze_{topic}", payload_format="json"))
        bronze = AuditedTable(spark, f"{base}/bronze_{topic}").read()
        reports.append(
            bronze.groupBy("kafka_topic")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.count_distinct("user_id").alias("users"),
                F.min("kafka_offset").alias("first_offset"),
                F.max("kafka_offset").alias("last_offset"),
            )
            .withColumn("target", F.lit(topic))
        )
    return reports[0].unionByName(reports[1])


@query(
    "topic_dead_letters",
    f"""
    select *, event_at >= timestamp '{inputs.SCHEMA_CHANGE_AT}' as was_dead from ({_DECODED})
    """,
)
def topic_dead_letters(spark, sf_dir):
    """A topic read with a registry that lacks the newer schema, and the rest replayed after a reload."""
    base = scratch_path(spark, "dead")
    registry = inputs.registry(spark)
    stream = read_topic_files(spark, _landed_topic(spark, sf_dir, base))
    settings = {"path": f"{base}/bronze", "dead_letters": f"{base}/dead", "key_alias": "user_key", "payload_format": "json"}
    drain(ingest_topic(stream, registry.where("schema_id = 1"), "pagos", "dev", f"{base}/checkpoints", **settings))
    dead = AuditedTable(spark, f"{base}/dead").read().select(F.col("offset").alias("kafka_offset"), F.lit(True).alias("was_dead"))
    for _ in range(2):
        replay_dead_letters(registry, "pagos", "dev", **settings)
    found = AuditedTable(spark, f"{base}/bronze").read().join(dead, "kafka_offset", "left").na.fill(False, ["was_dead"])
    return _decoded_columns(found, "was_dead")


@query(
    "topic_gaps",
    f"""
    with kept as (select user_id % 4 as part, row_number() over (partition by user_id % 4 order by event_id) - 1 as place, event_id from events),
    read as (select * from kept where not (place % 50 between 20 and 24 or place % 1000 = 999)),
    steps as (select part, place, lag(place) over (partition by part order by place) as before from read)
    select cast(part as integer) as "partition", before + 1 as first_missing, place - 1 as last_missing, place - before - 1 as missing
    from steps where place > before + 1
    """,
)
def topic_gaps(spark, sf_dir):
    """Holes in the offsets of a topic that was read with some messages missing and some twice."""
    along = Window.partitionBy("partition").orderBy("event_id")
    events = table(spark, sf_dir, "events").select(F.lit("pagos").alias("topic"), F.pmod("user_id", F.lit(4)).cast("int").alias("partition"), "event_id")
    placed = events.select("topic", "partition", (F.row_number().over(along) - 1).cast("long").alias("offset"))
    lost = (F.col("offset") % 50).between(20, 24) | (F.col("offset") % 1000 == 999)
    read = placed.where(~lost)
    runs = offset_runs(read.unionByName(read.where("offset % 7 = 0")), block=200)
    return check_offsets(runs, fail_on_data_loss=False).drop("topic")


@query(
    "topic_resume",
    """
    with placed as (select user_id % 4 as part, row_number() over (partition by user_id % 4 order by event_id) - 1 as place from events),
    read as (select * from placed where part <> 3 or place <> 5)
    select cast(part as integer) as "partition", max(place) + 1 as after_all,
           case when part = 3 and count(*) > 5 then 5 else max(place) + 1 end as at_first_hole from read group by part
    """,
)
def topic_resume(spark, sf_dir):
    """Where reading goes on per partition: behind everything, or at the first hole."""
    along = Window.partitionBy("partition").orderBy("event_id")
    events = table(spark, sf_dir, "events").select(F.lit("pagos").alias("topic"), F.pmod("user_id", F.lit(4)).cast("int").alias("partition"), "event_id")
    placed = events.select("topic", "partition", (F.row_number().over(along) - 1).cast("long").alias("offset"))
    runs = offset_runs(placed.where("partition <> 3 or offset <> 5"))
    after = resume_offsets(runs).withColumnRenamed("next_offset", "after_all")
    hole = resume_offsets(runs, skip_gaps=False).withColumnRenamed("next_offset", "at_first_hole")
    return after.join(hole, ["topic", "partition"]).drop("topic")
