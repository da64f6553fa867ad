"""Audited tables and their audit, named views, triggers, catalog sinks, cursor pulls, views, expectations, the shared folder."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.operators.cdc import ChangeRules
from tidemark.operators.quality import expect, expect_stream, expectation_metrics
from tidemark.operators.views import CUSTOMER_EXPECTATIONS
from tidemark.plans.catalogue import QUERIES
from tidemark.plans.jobs import PullError, core_tables, pull_into, silver_views
from tidemark.sources.cursor import (
    cursor_text,
    cursor_value,
    even_cuts,
    even_predicates,
    jdbc_reader,
    part_of,
    pull_by_cursor,
)
from tidemark.streaming import tables
from tidemark.streaming.audit import WriteAudit
from tidemark.streaming.change_targets import ChangeTarget
from tidemark.streaming.sinks import append_audited, append_stream, drain, for_each_batch, safe_name, trigger_options
from tidemark.streaming.tables import AuditedTable, NamedView, describe_table, refresh_view


def at(day):
    return datetime(2024, 1, day)


def test_appends_merge_columns_and_skip_replays(spark, base):
    table = AuditedTable(spark, base)
    with pytest.raises(ValueError, match="not been written"):
        table.read()
    table.append(spark.range(2), "w", 0)
    table.append(spark.range(2), "w", 0)
    table.append(spark.range(2, 3).withColumn("x", F.lit("n")), "w", 1)
    again = AuditedTable(spark, base)
    assert sorted((r["id"], r["x"]) for r in again.read().collect()) == [(0, None), (1, None), (2, "n")]
    assert [r["version"] for r in again.history().orderBy("version").collect()] == [0, 1]
    with pytest.raises(ValueError, match="is bigint in the table"):
        again.append(spark.range(1).select(F.lit("a").alias("id")), "w", 2)
    assert again.read().count() == 3


def test_a_repeated_write_replaces_its_own_rows_only(spark, base):
    table = AuditedTable(spark, base)
    table.append(spark.range(2), "w", 0)
    spark.range(7).write.parquet(f"{base}/data/w/1")  # what a writer left that died before its audit row
    table.append(spark.range(10, 13), "w", 1)
    assert sorted(r["id"] for r in AuditedTable(spark, base).read().collect()) == [0, 1, 10, 11, 12]
    assert [(r["version"], r["rows"]) for r in table.history().collect()] == [(0, 2), (1, 3)] and table.parts == ["w/0", "w/1"]


def catalog_name(base, name):
    return f"{name}_{base.rsplit('-', 1)[-1]}"


def test_a_view_may_read_itself(spark, base):
    name = catalog_name(base, "numbers")
    view = refresh_view(spark.range(5), name)
    before = view.read()
    refresh_view(view.read().where("id > 2"), name)
    assert spark.table(name).count() == 2 and before.count() == 5


def test_a_reader_never_misses_a_view_and_old_tables_go(spark, base):
    name = catalog_name(base, "steady")
    view = refresh_view(spark.range(1), name, "it's steady")
    seen, stop = [], threading.Event()

    def read():
        try:
            while not stop.is_set():
                seen.append(spark.table(name).count())
        except Exception as error:
            seen.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(2, 12):
            view.refresh(spark.range(n), "it's steady", {"n": str(n)})
    finally:
        stop.set()
        reader.join()
    assert len(seen) > 5 and seen == sorted(seen) and set(seen) <= set(range(1, 12))
    assert len(view.versions()) == 2 and view.read().count() == 11
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe table extended {name}").collect()}
    assert about["Comment"] == "it's steady"
    with pytest.raises(ValueError, match="keep"):
        NamedView(spark, name, 0)


def test_triggers_and_names():
    assert trigger_options("available_now") == {"availableNow": True}
    assert trigger_options("processing_time", "15 seconds") == {"processingTime": "15 seconds"}
    with pytest.raises(ValueError, match="interval"):
        trigger_options("processing_time")
    with pytest.raises(ValueError, match="unknown trigger"):
        trigger_options("once")
    assert safe_name("cards.payments-v1 ñ") == "cards_payments_v1__"


def test_catalog_sink_restarts_without_reprocessing(spark, base):
    name = "sink_" + base.rsplit("-", 1)[-1]
    spark.range(4).write.parquet(f"{base}/in/0")

    def run():
        stream = spark.readStream.schema("id long").parquet(f"{base}/in/*")
        query = append_stream(stream, name, f"{base}/cp", name=f"job_{name}", path=f"{base}/table")
        assert query.name == f"job_{name}"
        drain(query)
        spark.catalog.refreshTable(name)
        return spark.table(name).count()

    assert run() == 4 and run() == 4
    spark.range(3).write.parquet(f"{base}/in/1")
    assert run() == 7
    describe_table(spark, name, "it's a sink", {"quality": "raw"})
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe extended {name}").collect()}
    assert described["Comment"] == "it's a sink" and "quality=raw" in described["Table Properties"]


def test_catalog_sink_takes_up_new_columns(spark, base):
    name = "wide_" + base.rsplit("-", 1)[-1]
    spark.range(2).write.parquet(f"{base}/in/0")

    def run(schema):
        stream = spark.readStream.schema(schema).parquet(f"{base}/in/*")
        drain(append_stream(stream, name, f"{base}/cp", path=f"{base}/table"))
        spark.catalog.refreshTable(name)
        return sorted(map(tuple, spark.table(name).collect()))

    assert run("id long") == [(0,), (1,)]
    spark.range(2, 3).withColumn("x", F.lit("n")).write.parquet(f"{base}/in/1")
    assert run("id long, x string") == [(0, None), (1, None), (2, "n")]


def test_expectations_on_a_stream(spark, base):
    spark.range(4).write.parquet(f"{base}/in")
    stream = expect_stream(spark.readStream.schema("id long").parquet(f"{base}/in"), "rules", {"large": "id > 0"})
    query = drain(append_audited(stream, f"{base}/table", f"{base}/cp"))
    seen = [p["observedMetrics"]["rules"].asDict() for p in query.recentProgress if p["numInputRows"]]
    assert seen == [{"large_passed": 3, "large_failed": 1}]
    assert AuditedTable(spark, f"{base}/table").read().count() == 4


def test_failures_reach_the_caller(spark, base):
    spark.range(4).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("id long").parquet(f"{base}/in")

    def fail(batch, writer, number):
        raise RuntimeError("batch went wrong")

    with pytest.raises(Exception, match="batch went wrong"):
        drain(for_each_batch(stream, fail, f"{base}/cp"))


PULL = "id long, v string, changed timestamp_ntz"


def test_cursor_boundary_row_is_not_lost(spark, base):
    target = ChangeTarget(spark, base, ChangeRules(["id"], "changed"), 2)
    source = [(1, "a", at(1)), (2, "b", at(2))]
    pull_into(target, lambda: spark.createDataFrame(source, PULL), "changed")
    source += [(3, "c", at(2)), (1, "a2", at(3))]
    pull_into(target, lambda: spark.createDataFrame(source, PULL), "changed")
    pull_into(target, lambda: spark.createDataFrame(source, PULL), "changed")
    found = {(r["id"], r["v"], r["__START_AT"], r["__END_AT"]) for r in target.read().collect()}
    assert found == {(1, "a", at(1), at(3)), (1, "a2", at(3), None), (2, "b", at(2), None), (3, "c", at(2), None)}
    pulled = [r["n"] for r in spark.read.parquet(*[f"{base}/pulls/data/pull/{n}" for n in range(3)]).selectExpr("count(*) n").collect()]
    assert pulled == [2 + 3 + 1]


def test_a_pull_that_was_not_applied_is_applied_first(spark, base, monkeypatch):
    target = ChangeTarget(spark, base, ChangeRules(["id"], "changed"), 1)
    merge = ChangeTarget.merge
    monkeypatch.setattr(ChangeTarget, "merge", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost the driver")))
    with pytest.raises(RuntimeError):
        pull_into(target, lambda: spark.createDataFrame([(1, "gone", at(1))], PULL), "changed")
    monkeypatch.setattr(ChangeTarget, "merge", merge)
    pull_into(target, lambda: spark.createDataFrame([(2, "b", at(2))], PULL), "changed")
    assert sorted(r["v"] for r in target.read().collect()) == ["b", "gone"]


def test_cursor_filter_is_pushed_to_the_source(spark, base, capsys):
    spark.createDataFrame([(1, "a", at(1))], PULL).write.parquet(base)
    pull_by_cursor(lambda: spark.read.parquet(base), "changed", "2024-01-01 00:00:00").explain("formatted")
    assert "GreaterThanOrEqual(changed,2024-01-01T00:00)" in capsys.readouterr().out


class RecordedReader:
    """Stands in for ``spark.read``: keeps the options and answers the query for the bounds."""

    def __init__(self, answer, log):
        self.answer, self.log, self.seen = answer, log, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def option(self, name, value):
        self.seen[name] = value
        return self

    def load(self):
        self.log.append(self.seen)
        return self.answer


@pytest.mark.parametrize(
    "low, high, bounds",
    [
        ("timestamp'2024-01-01 00:00:00'", "timestamp'2024-02-01 10:00:00.5'", ("2024-01-01 00:00:00", "2024-02-01 10:00:00.5")),
        ("cast(3.7 as decimal(9,2))", "cast(99.2 as decimal(9,2))", ("3", "99")),
        ("cast(null as bigint)", "cast(null as bigint)", None),
    ],
)
def test_jdbc_reads_are_partitioned_by_the_range_found(spark, low, high, bounds):
    log, answer = [], spark.sql(f"select {low} as low, {high} as high")
    session = type("Session", (), {"read": property(lambda _: RecordedReader(answer, log))})()
    jdbc_reader(session, "jdbc:x", "public.cuota", "changed", {"user": "u"}, 8)()
    asked, whole = log
    assert asked["query"] == "SELECT MIN(changed) AS low, MAX(changed) AS high FROM public.cuota"
    assert (whole["dbtable"], whole["user"], whole["url"]) == ("public.cuota", "u", "jdbc:x")
    if bounds is None:
        assert "partitionColumn" not in whole
    else:
        assert (whole["partitionColumn"], whole["numPartitions"]) == ("changed", 8)
        assert (whole["lowerBound"], whole["upperBound"]) == bounds


@pytest.mark.parametrize(
    "last, condition",
    [("7", "7"), ("2024-01-05 00:00:00", "'2024-01-05 00:00:00'"), ("1704412800000001 us", "TIMESTAMP '2024-01-05 00:00:00.000001+00:00'")],
)
def test_later_jdbc_pulls_cut_the_range_that_is_left(spark, last, condition):
    log, answer = [], spark.sql("select cast(7 as bigint) as low, cast(9 as bigint) as high, 7L as changed")
    session = type("Session", (), {"read": property(lambda _: RecordedReader(answer, log))})()
    pull_by_cursor(jdbc_reader(session, "jdbc:x", "t", "id", None, 8), "changed", last)
    asked, whole = log
    assert asked["query"] == f"SELECT MIN(id) AS low, MAX(id) AS high FROM t WHERE changed >= {condition}"
    assert (whole["lowerBound"], whole["upperBound"], whole["numPartitions"]) == ("7", "9", 8)


def test_cursor_values_mean_the_same_in_every_zone(spark):
    rows = spark.sql("select timestamp'2024-01-05 01:02:03.000004Z' as changed")
    text = rows.agg(cursor_text(rows, "changed")).first()[0]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert pull_by_cursor(lambda: rows, "changed", text).count() == 1
        assert rows.where(rows["changed"] > cursor_value(text, rows.schema["changed"].dataType)).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_core_tables_to_silver_views(spark, base):
    def read(name):
        return {
            "cliente": spark.createDataFrame(
                [
                    (1, "DNI", "  Ana ", "Paz ", None, None, at(1)),
                    (2, None, "Luis", " Rey", None, None, at(1)),
                ],
                "cliente_id long, tipo_documento_codigo string, nombres string, apellidos string, "
                "fecha_nacimiento date, fecha_alta date, fec_modificacion timestamp_ntz",
            ),
            "cuenta": spark.createDataFrame([(1, 5.0, at(1))], "cuenta_id long, saldo double, fec_modificacion timestamp_ntz"),
            "cuota": spark.createDataFrame([(1, 5.0, at(1))], "cuota_id long, monto_programado double, fec_modificacion timestamp_ntz"),
            "prestamo": spark.createDataFrame(
                [(9, 1, "P1", "VIG", 10.0, 0.1, 12, None, at(day)) for day in days]
                + [(8, 2, "GONE", "VIG", 20.0, 0.2, 6, None, at(1))],
                "prestamo_id long, cliente_id long, producto_codigo string, estado_prestamo_codigo string, "
                "monto_original double, tasa_anual double, numero_cuotas int, fecha_desembolso date, fec_modificacion timestamp_ntz",
            ),
        }[name]

    days = [1]
    core_tables(spark, read, f"{base}/core")
    days = [3]
    core = core_tables(spark, read, f"{base}/core")
    feed = "codigo string, descripcion string, operation string, event_ts timestamp_ntz"
    products = ChangeTarget(
        spark, f"{base}/products", ChangeRules(["codigo"], "event_ts", "operation = 'DELETE'", ["operation", "event_ts"]), 1
    )
    changes = [("P1", "old", "INSERT", at(1)), ("P1", "Hipoteca", "UPDATE", at(2)), ("GONE", "x", "INSERT", at(1)), ("GONE", None, "DELETE", at(2))]
    products.merge(spark.createDataFrame(changes, feed), "job", 0)
    name = "m_cliente_" + base.rsplit("-", 1)[-1]
    names = {v: catalog_name(base, v) for v in ("m_cliente", "h_prestamo", "m_prestamo")}
    views = silver_views(core, products, f"{base}/silver", names)
    assert spark.table(name).count() == 2
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe table extended {name}").collect()}
    assert about["Comment"] == "Current customers"
    logged = AuditedTable(spark, f"{base}/silver/expectations").read().collect()
    assert [tuple(r) for r in logged] == [(0, "m_cliente", "tipdoc_no_nulo", 1, 1)]
    customers = sorted(map(tuple, views["m_cliente"].read().collect()))
    assert customers == [(1, "DNI", "Ana", "Paz", None, None), (2, None, "Luis", "Rey", None, None)]
    history = views["h_prestamo"].read().collect()
    assert sorted((r["prestamo_id"], r["producto"], r["__START_AT"], r["__END_AT"]) for r in history if r["prestamo_id"] == 9) == [
        (9, "Hipoteca", at(1), at(3)),
        (9, "Hipoteca", at(3), None),
    ]
    current = {(r["prestamo_id"], r["producto"]) for r in views["m_prestamo"].read().collect()}
    assert current == {(9, "Hipoteca"), (8, None)}
    metrics = expectation_metrics(views["m_cliente"].read(), CUSTOMER_EXPECTATIONS).collect()
    assert [tuple(r) for r in metrics] == [("tipdoc_no_nulo", 1, 1)]


def test_expectations_keep_the_rows(spark, base):
    df = spark.createDataFrame([(1,), (None,), (-3,)], "a int")
    kept, seen = expect(df, {"positive": "a > 0", "set": "a is not null"})
    assert kept.count() == 3
    assert seen.get == {"positive_passed": 1, "positive_failed": 2, "set_passed": 2, "set_failed": 1}


def test_shared_folder_rules(spark, monkeypatch):
    class Session:
        def __init__(self, master, configured):
            self.sparkContext = type("C", (), {"master": master})()
            self.values = {workspace.CHECKPOINT_CONF: configured} if configured else {}
            self.conf = type("R", (), {"get": lambda _, k, d: self.values.get(k, d), "set": lambda _, k, v: self.values.update({k: v})})()

    assert workspace.shared_dir(Session("spark://m:7077", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="executors can reach"):
        workspace.shared_dir(Session("spark://m:7077", None))
    local = Session("local[2]", None)
    assert workspace.shared_dir(local) == workspace.shared_dir(local)


def test_two_writers_lose_nothing(spark, base, monkeypatch):
    """A second writer commits between the first one's look at the table and its write."""
    first, second = AuditedTable(spark, base), AuditedTable(spark, base)
    first.append(spark.range(0, 1), "a", 0)
    assert first.schema == second.schema
    commit = tables.write_line

    def interleaved(*args):
        monkeypatch.setattr(tables, "write_line", commit)
        second.append(spark.range(10, 11).withColumn("x", F.lit("b")), "b", 0)
        commit(*args)

    monkeypatch.setattr(tables, "write_line", interleaved)
    first.append(spark.range(20, 21), "a", 1)
    found = AuditedTable(spark, base).read().collect()
    assert sorted((r["id"], r["x"]) for r in found) == [(0, None), (10, "b"), (20, None)]
    assert AuditedTable(spark, base).history().count() == 3


def test_a_listener_notes_every_micro_batch(spark, base):
    """Through Spark's own file sink and through a function per batch."""
    name = catalog_name(base, "noted")
    for n in range(3):
        spark.range(n * 10, n * 10 + 4).coalesce(1).write.parquet(f"{base}/in/{n}")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    with WriteAudit(spark, f"{base}/audit") as audit:
        job = drain(append_stream(expect_stream(stream, "rules", {"even": "id % 2 = 0"}), name, f"{base}/cp", name=name, path=f"{base}/table"))
        rows = audit.wait_for(job).orderBy("batch_id").collect()
        other = drain(append_audited(stream, f"{base}/audited", f"{base}/cp2"))
        assert [r["input_rows"] for r in audit.wait_for(other).collect()] == [4, 4, 4]
    assert [(r["query_name"], r["batch_id"], r["input_rows"]) for r in rows] == [(name, n, 4) for n in range(3)]
    assert all(r["started_at"] <= r["ended_at"] and f"{base}/table" in r["sink"] and f"{base}/in" in r["source"] for r in rows)
    assert rows[0]["metrics"] == {"rules": {"even_passed": "2", "even_failed": "2"}}
    assert audit.rows().count() == 6


def test_sink_without_merging_refuses_new_columns(spark, base):
    name = catalog_name(base, "narrow")
    spark.range(2).write.parquet(f"{base}/in/0")

    def run(schema):
        stream = spark.readStream.schema(schema).parquet(f"{base}/in/*")
        drain(append_stream(stream, name, f"{base}/cp", path=f"{base}/table", merge_columns=False))

    run("id long")
    with pytest.raises(ValueError, match="has no column x"):
        run("id long, x string")


def hot_day(spark):
    """A third of the rows on one instant, a third within a day, the rest over a year."""
    at = "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, {}, 0, {})"
    return spark.range(30_000).selectExpr(
        "id", f"case id % 3 when 0 then timestamp_ntz'2024-05-05' when 1 then {at.format(125, 'cast(id % 1440 as int)')} "
        f"else {at.format('cast(id % 365 as int)', 0)} end as changed", "if(id % 1000 = 0, null, id) as other",
    )


def test_even_parts_of_a_skewed_cursor(spark, base):
    rows = hot_day(spark)
    rows.write.parquet(base)
    rows = spark.read.parquet(base)
    cuts = even_cuts(rows, "changed", 16, "id", per_part=200)
    sizes = [r["count"] for r in rows.groupBy(part_of(rows, cuts, "changed", "id")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 30_000 / 16 and sum(sizes) == 30_000
    plain = even_cuts(rows, "changed", 16)
    assert len(plain) < 16  # one instant cannot be cut without a tie


def test_even_predicates_hold_for_every_row_once(spark):
    rows = hot_day(spark).withColumn("changed", F.expr("if(id % 777 = 0, null, changed)"))
    for tie in (None, "id", "other"):
        cuts = even_cuts(rows, "changed", 8, tie, per_part=50)
        conditions = even_predicates(cuts, "changed", tie)
        times = sum(F.coalesce(F.expr(c.replace("TIMESTAMP", "TIMESTAMP_NTZ")), F.lit(False)).cast("int") for c in conditions)
        assert [tuple(r) for r in rows.groupBy(times.alias("times")).count().collect()] == [(1, 30_000)]
    assert even_predicates([], "x") == ["1 = 1"] and even_cuts(rows.where("false"), "changed", 4) == []
    assert even_predicates([("it's",)], "x") == ["(x < 'it''s' OR x IS NULL)", "NOT x < 'it''s'"]


def test_pulls_overlap_and_failures_are_told_together(spark, base):
    meet = threading.Barrier(2, timeout=60)
    good = spark.createDataFrame([(1, "a", at(1))], PULL)

    def read(name):
        if name in ("one", "two"):
            meet.wait()  # passes only if both are being pulled
            return good
        raise RuntimeError(f"no table {name}")

    tables_ = {"one": ("id", 1), "bad": ("id", 1), "two": ("id", 2), "worse": ("id", 1)}
    with pytest.raises(PullError) as failed:
        core_tables(spark, read, base, tables_, "changed")
    assert set(failed.value.failures) == {"bad", "worse"} and "no table bad" in str(failed.value)
    again = core_tables(spark, lambda name: good, base, tables_, "changed")
    assert [again[n].read().count() for n in tables_] == [1, 1, 1, 1]


def test_keyed_state_runs_in_a_session_of_default_settings(spark, base):
    """Only the query itself gets the state store it needs."""
    (setting,) = workspace.KEYED_STATE
    before = spark.conf.get(setting)
    events = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    at = [datetime(2024, 1, day) for day in (1, 2, 3)]
    rows = [
        (1, at[0], 1, "view", 1.0, None), (2, at[2], 1, "view", 2.0, None), (3, at[1], 1, "view", 3.0, None),
        (4, at[0], 2, "view", 4.0, None), (5, at[1], 2, "error", 5.0, None), (6, at[0], 3, "signup", 6.0, None),
        (7, at[0], 4, "view", 60.0, None), (8, at[0], 5, "view", 7.0, None),
    ]
    spark.createDataFrame(rows, events).write.parquet(f"{base}/events.parquet")
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(setting, other)
    try:
        current = [(r["user_id"], r["event_id"]) for r in QUERIES["scd1_streaming"](spark, base).collect()]
        refused = [(r["event_id"], r["reject_reason"]) for r in QUERIES["stream_rejects"](spark, base).collect()]
        assert spark.conf.get(setting) == other
    finally:
        spark.conf.set(setting, before)
    assert sorted(current) == [(1, 2), (3, 6), (4, 7), (5, 8)]
    assert sorted(refused) == [(6, "null sequence"), (7, "null key")]
