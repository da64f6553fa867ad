"""By-name CSV ingestion: headers, rescue, evolution, restarts."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.reports import rescued_rows, rescued_summary, table_profile
from tidemark.plans.jobs import ingest_lots, product_dimension
from tidemark.sources.batch import file_inventory, read_csv
from tidemark.sources import csv_lots
from tidemark.sources.csv_lots import first_lines, group_by_header, infer_types
from tidemark.streaming.files import SchemaLog, ingest_files
from tidemark.streaming.sinks import drain
from tidemark.streaming.tables import AuditedTable

FIXED = T.StructType().add("id", "integer").add("name", "string").add("qty", "integer")


def fixed(spark, base, **more):
    drain(ingest_lots(spark, f"{base}/in", f"{base}/table", f"{base}/job", FIXED, **more))
    return {r["id"]: r for r in AuditedTable(spark, f"{base}/table").read().collect()}


def evolving(spark, base, **more):
    drain(ingest_lots(spark, f"{base}/in", f"{base}/table", f"{base}/job", **more))
    return AuditedTable(spark, f"{base}/table").read()


def test_fixed_schema_rescues_everything_else(spark, base, put):
    put("in/1.csv", "id,name,qty\n1,a,5\n2,\"b,c\",bad\n")
    put("in/2.csv", "qty,extra,id,name\n7,x,3,d\n", "utf-8-sig")
    put("in/3.csv", "name,id\ne,4\n")
    put("in/4.csv", 'id,name,qty,"pri,o"\n5,f,1,HI\n')
    put("in/5.csv", "")
    put("in/6.csv", "id,name,qty\n")
    put("in/7[x].csv", "id,name,qty\n6,g,2,surplus\n7,h\n")
    found = fixed(spark, base)
    kept = {i: (r["name"], r["qty"], json.loads(r["_rescued_data"]) if r["_rescued_data"] else None) for i, r in found.items()}
    assert kept == {
        1: ("a", 5, None),
        2: ("b,c", None, {"qty": "bad"}),
        3: ("d", 7, {"extra": "x"}),
        4: ("e", None, None),
        5: ("f", 1, {"pri,o": "HI"}),
        6: ("g", 2, {"_corrupt_record": "6,g,2,surplus"}),
        7: ("h", None, {"_corrupt_record": "7,h"}),
    }
    assert found[1]["_source_file"] == "1.csv" and found[1]["_ingestion_timestamp"] is not None


def test_quoted_newline_needs_the_option(spark, base, put):
    put("in/1.csv", 'id,"na\nme",qty\n1,"a\nb",5\n')
    drain(
        ingest_files(
            spark, f"{base}/in", f"{base}/table", f"{base}/cp", schema=FIXED, evolution="rescue", options={"multiLine": "true"}
        )
    )
    row = AuditedTable(spark, f"{base}/table").read().first()
    assert (row["id"], row["qty"], json.loads(row["_rescued_data"])) == (1, 5, {"na\nme": "a\nb"})


def test_columns_that_differ_in_case_only(spark, base, put):
    put("in/1.csv", "id,ID,name,qty\n1,2,a,3\n")
    found = fixed(spark, base)
    assert json.loads(found[1]["_rescued_data"]) == {"ID": "2"}


def test_repeated_column_is_an_error(spark, base, put):
    put("in/1.csv", "id,id\n1,2\n")
    with pytest.raises(Exception, match="repeated column id"):
        fixed(spark, base)


def test_evolution_adds_columns_and_freezes_types(spark, base, put):
    put("in/1.csv", "id,qty\n1,5\n2,6\n")
    evolving(spark, base)
    put("in/2.csv", "qty,id,pri\n7.5,3,HI\n8,4,LO\n")
    put("in/3.csv", "id,day,pri\n5,2024-01-02,MID\n")
    table = evolving(spark, base)
    assert [(f.name, f.dataType.simpleString()) for f in table.schema if not f.name.startswith("_")] == [
        ("id", "int"),
        ("qty", "int"),
        ("pri", "string"),
        ("day", "date"),
    ]
    found = {r["id"]: (r["qty"], r["pri"], r["_rescued_data"]) for r in table.collect()}
    assert found == {
        1: (5, None, None),
        2: (6, None, None),
        3: (None, "HI", '{"qty":"7.5"}'),
        4: (8, "LO", None),
        5: (None, "MID", None),
    }
    version, schema = SchemaLog(spark, f"{base}/job/schema_log").read()
    assert version == 1 and schema.names == ["id", "qty", "pri", "day"]


def test_evolution_keeps_the_first_spelling_and_names_blank_columns(spark, base, put):
    put("in/1.csv", "id,qty,\n1,5,x\n")
    evolving(spark, base)
    put("in/2.csv", "ID,qty\n2,6\n")
    table = evolving(spark, base)
    assert table.columns[:3] == ["id", "qty", "_c2"]
    assert {(r["id"], r["qty"], r["_c2"], r["_rescued_data"]) for r in table.collect()} == {
        (1, 5, "x", None),
        (None, 6, None, '{"ID":"2"}'),
    }


def test_a_rerun_adds_nothing_and_batches_are_bounded(spark, base, put):
    for n in range(5):
        put(f"in/{n}.csv", f"id,qty\n{n},{n}\n")
    assert evolving(spark, base, max_files=2).count() == 5
    table = AuditedTable(spark, f"{base}/table")
    assert len(table.parts) == 3
    assert evolving(spark, base, max_files=2).count() == 5
    assert table.refresh().history().count() == 3
    per_batch = [int(r["operation_parameters"]["files"]) for r in table.history().collect()]
    assert sorted(per_batch) == [1, 2, 2]


def test_failure_after_the_schema_log_is_repaired_by_a_rerun(spark, base, put, monkeypatch):
    put("in/1.csv", "id,qty\n1,5\n")
    evolving(spark, base)
    put("in/2.csv", "id,qty,pri\n2,6,HI\n")
    whole = AuditedTable.append

    def dies(self, *args):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(AuditedTable, "append", dies)
    with pytest.raises(Exception, match="lost the driver"):
        evolving(spark, base)
    assert AuditedTable(spark, f"{base}/table").read().count() == 1
    monkeypatch.setattr(AuditedTable, "append", whole)
    found = {r["id"]: r["pri"] for r in evolving(spark, base).collect()}
    assert found == {1: None, 2: "HI"}


def test_argument_checks(spark, base):
    with pytest.raises(ValueError, match="unknown evolution mode"):
        ingest_files(spark, base, base, base, schema=FIXED, evolution="other")
    with pytest.raises(ValueError, match="need one"):
        ingest_files(spark, base, base, base, evolution="rescue")
    with pytest.raises(ValueError, match="different paths"):
        ingest_files(spark, base, base, f"{base}/x", schema_log=f"{base}/x/")
    with pytest.raises(ValueError, match="max_files"):
        ingest_files(spark, base, base, f"{base}/x", schema_log=f"{base}/y", max_files=0)


LOT3 = T.StructType([T.StructField(n, T.StringType()) for n in ("orden_id", "lote_proceso", "cliente_id")])
LOT3 = LOT3.add("cantidad", "integer").add("total_linea", "double")


def test_order_lot_with_unexpected_columns(spark, base, put):
    """Ten orders with two columns outside the fixed schema."""
    priorities = ["EXPRESS", "URGENTE", "NORMAL", "NORMAL", "EXPRESS", "URGENTE", "NORMAL", "EXPRESS", "EXPRESS", "URGENTE"]
    amounts = [7, 4, 3, 4, 2, 7, 9, 10, 4, 10]
    lines = ["orden_id,lote_proceso,cliente_id,cantidad,total_linea,prioridad_envio,campo_extra_inesperado"]
    for i, (priority, amount) in enumerate(zip(priorities, amounts)):
        lines.append(f"ORD-{391 + i:06},LOTE-2024-03-03,CLI999,{amount},500.0,{priority},valor_inesperado_{i}")
    put("in/lote3.csv", "\n".join(lines) + "\n")
    drain(ingest_lots(spark, f"{base}/in", f"{base}/table", f"{base}/job", LOT3))
    table = AuditedTable(spark, f"{base}/table").read()
    assert [tuple(r) for r in rescued_summary(table, "lote_proceso").collect()] == [("LOTE-2024-03-03", 10, 10)]
    assert table.selectExpr("sum(cantidad)", "sum(total_linea)").first()[:] == (60, 5000.0)
    first = rescued_rows(table, "orden_id", 1).first()
    assert tuple(first) == ("ORD-000391", '{"prioridad_envio":"EXPRESS","campo_extra_inesperado":"valor_inesperado_0"}')
    assert table_profile(table).first()["column_count"] == 8


def test_product_feed_into_both_tables(spark, base, put):
    put("in/1.csv", "codigo,descripcion,operation,event_ts\nA,a1,INSERT,2024-01-01 10:00:00\nB,b1,INSERT,2024-01-01 10:00:00\n")

    def run():
        query, current, history = product_dimension(spark, f"{base}/in", f"{base}/out")
        drain(query)
        one = sorted(map(tuple, current.read().collect()))
        two = sorted(tuple(map(str, r)) for r in history.read().collect())
        return one, two

    run()
    put("in/2.csv", "event_ts,codigo,operation,descripcion\n2024-01-01 12:00:00,A,UPDATE,a3\n2024-01-01 11:00:00,A,UPDATE,a2\n2024-01-01 11:00:00,B,DELETE,\n")
    one, two = run()
    assert one == [("A", "a3")]
    day = "2024-01-01"
    assert two == [
        ("A", "a1", f"{day} 10:00:00", f"{day} 11:00:00"),
        ("A", "a2", f"{day} 11:00:00", f"{day} 12:00:00"),
        ("A", "a3", f"{day} 12:00:00", "None"),
        ("B", "b1", f"{day} 10:00:00", f"{day} 11:00:00"),
    ]
    assert run() == (one, two)
    bronze = AuditedTable(spark, f"{base}/out/bronze").read()
    assert bronze.count() == 5 and {"_source_metadata", "_ingested_at"} <= set(bronze.columns)


def test_batch_reads_and_inventory(spark, base, put):
    path = put("in/a.csv", "x,y\n1,2\n")
    assert read_csv(spark, path).columns == ["x", "y"]
    assert [tuple(r) for r in read_csv(spark, path, header=False).collect()] == [("x", "y"), ("1", "2")]
    found = file_inventory(spark, f"{base}/in").first()
    assert (found["name"], found["length"]) == ("a.csv", os.path.getsize(path))


def test_fields_named_like_technical_columns_are_rescued(spark, base, put):
    put("in/a.csv", "id,_source_file,_Ingestion_Timestamp\n1,x,y\n")
    for _ in range(2):
        drain(ingest_lots(spark, f"{base}/in", f"{base}/out", f"{base}/job"))
    row = AuditedTable(spark, f"{base}/out").read().collect()[0]
    assert row["id"] == 1 and row["_source_file"] == "a.csv"
    assert row["_rescued_data"] == '{"_source_file":"x","_Ingestion_Timestamp":"y"}'
    with pytest.raises(ValueError, match="technical"):
        ingest_lots(spark, f"{base}/in", f"{base}/out2", f"{base}/job2", schema=T.StructType().add("_source_file", "string"))


def test_headers_of_many_files_take_one_job(spark, base, put):
    paths = [put(f"in/{n} é.csv", f"id,v{n % 3}\n{n},x\n") for n in range(50)]
    tracker, group = spark.sparkContext.statusTracker(), f"headers-{base[-8:]}"
    spark.sparkContext.setJobGroup(group, "headers")
    groups = group_by_header(spark, sorted(paths))
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert jobs <= 2 and {k: len(v) for k, v in groups.items()} == {("id", "v0"): 17, ("id", "v1"): 17, ("id", "v2"): 16}


def test_headers_of_large_files_read_their_beginning_only(spark, put):
    """A file of 600 times the size takes at most twice the time."""
    line = ",".join(["x" * 9] * 10) + "\n"
    small, large = put("in/s.csv", "a,b\n" + line * 10_000), put("in/l.csv", "a,c\n")
    with open(large, "a", encoding="utf-8") as file:
        for _ in range(600):
            file.write(line * 10_000)
    assert os.path.getsize(large) > 550_000_000
    took = {}
    for path in (small, small, large):
        start = time.monotonic()
        assert len(first_lines(spark, [path])) == 1
        took[path] = time.monotonic() - start
    assert took[large] < 2 * max(took[small], 0.3), took


def test_headers_by_size_and_with_quoted_line_feeds(spark, put):
    texts = {"a": 'id,"x\ny","z"\n1,2,3\n', "b": "", "c": "\n\nid\n", "d": "id\n", "e": 'id,"open\n'}
    paths = {n: put(f"in/{n}.csv", t) for n, t in texts.items()}
    for sizes in (None, {p: os.path.getsize(p) for p in paths.values()}):
        found = first_lines(spark, sorted(paths.values()), {"multiLine": "true"}, sizes)
        by_name = {n: found.get(p) for n, p in paths.items()}
        assert by_name["a"] == 'id,"x\ny","z"' and by_name["b"] is None and by_name["d"] == "id"


def test_types_of_new_columns(spark):
    rows = [("1", "3000000000", "1.5", "2024-01-02", "2024-01-02 03:04:05", "true", "1", None, "7f"), ("-2", "4", "2", "2024-1-3", "2024-01-02T03:04:05", "FALSE", "x", None, "2")]
    names = ["i", "l", "d", "day", "at", "yes", "mixed", "none", "hex"]
    found = infer_types(spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names)), names)
    assert [f.dataType.simpleString() for f in found] == ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string", "string"]


def test_files_with_new_columns_are_parsed_once(spark, base, put, monkeypatch):
    put("in/1.csv", "id,qty\n1,5\n")
    scans, whole = [], csv_lots.read_group
    monkeypatch.setattr(csv_lots, "read_group", lambda *a: scans.append(a[1]) or whole(*a))
    assert evolving(spark, base).schema["qty"].dataType == T.IntegerType()
    assert scans == [("id", "qty")]


def test_batches_bounded_by_bytes(spark, base, put):
    sizes = [os.path.getsize(put(f"in/{n}.csv", "id,qty\n" + f"{n},1\n" * 100)) for n in range(6)]
    drain(ingest_files(spark, f"{base}/in", f"{base}/table", f"{base}/cp", schema=FIXED, evolution="rescue", max_bytes=str(2 * max(sizes))))
    history = AuditedTable(spark, f"{base}/table").history().collect()
    taken = [int(r["operation_parameters"]["bytes"]) for r in history]
    assert len(taken) >= 3 and max(taken) <= 2 * max(sizes) and sum(taken) == sum(sizes) and sum(r["rows"] for r in history) == 600
    with pytest.raises(ValueError, match="both"):
        ingest_files(spark, base, base, f"{base}/x", schema=FIXED, evolution="rescue", max_files=3, max_bytes="1g")


def test_forms_come_before_casts_and_turn_no_text_away(spark):
    """A cast that fails is an exception inside Spark, and types are found by trying all of them on every text."""
    numbers = [
        "1", " 1 ", "+1.", "-.5", "1e5", "1E-5", "1.5d", "1.5f ", "1d ", "0x1p3", "0x.8p1f ", "0X1.P-2", "NaN", "-nan", "inf", " +Infinity ", "INF ",
        "1\u0001", "\t2\n", ".", "", "n/a", "1e", "0x1", "1 2", "ORD-1", "2024-01-01", "١", "infinit", "--1", "1,5", "1_0", "NaNd", "e5", "inf\u00a0", "\u00a01",
    ]
    texts = spark.createDataFrame([(n,) for n in numbers], "t string")
    plain = F.col("t").try_cast("double").isNotNull() & F.col("t").rlike(csv_lots._KINDS["double"])
    found = texts.select("t", plain.alias("plain"), csv_lots.has_type(F.col("t"), "double").alias("formed")).collect()
    assert [(r["t"], r["formed"]) for r in found] == [(r["t"], r["plain"]) for r in found]
    for kind in csv_lots._KINDS:
        told = str(csv_lots.has_type(F.col("t"), kind)).lower()
        assert told.index("rlike") < told.index("cast")
