"""SCD rules on inline rows, and against a plain Python model on random logs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.cdc import ChangeRules, current_versions, scd1, scd2, split_rejects
from tidemark.operators.neighbours import cut_points
from tidemark.operators.views import loan_current, loan_history
from tidemark.streaming.change_targets import ChangeTarget, merge_into

SCHEMA = "codigo string, descripcion string, operation string, event_ts timestamp_ntz"
RULES = ChangeRules(["codigo"], "event_ts", "operation = 'DELETE'", ["operation", "event_ts"])
ARGS = dict(
    keys=["codigo"],
    sequence_by="event_ts",
    apply_as_deletes="operation = 'DELETE'",
    except_columns=["operation", "event_ts"],
)


def at(hour, minute=0):
    return datetime(2024, 1, 1) + timedelta(hours=hour, minutes=minute)


FEED = [
    ("A", "a1", "INSERT", at(10)),
    ("A", "a3", "UPDATE", at(12)),
    ("A", "a2", "UPDATE", at(11)),
    ("B", "b1", "INSERT", at(10)),
    ("B", None, "DELETE", at(11)),
    ("B", "b0", "UPDATE", at(9)),
    ("C", None, "DELETE", at(10)),
]
CURRENT = [("A", "a3")]
HISTORY = [
    ("A", "a1", at(10), at(11)),
    ("A", "a2", at(11), at(12)),
    ("A", "a3", at(12), None),
    ("B", "b0", at(9), at(10)),
    ("B", "b1", at(10), at(11)),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def model(log):
    """Versions (key, text, start, end) of rows (key, text, operation, time), by the written rules."""
    points = {}
    for key, text, operation, time in log:
        if key is None or time is None:
            continue
        rank = (operation == "DELETE", text is not None, text or "")
        if (key, time) not in points or points[key, time][0] < rank:
            points[key, time] = (rank, text, operation)
    versions = []
    for key in {k for k, _ in points}:
        times = sorted(t for k, t in points if k == key)
        for start, end in zip(times, [*times[1:], None]):
            _, text, operation = points[key, start]
            if operation != "DELETE":
                versions.append((key, text, start, end))
    return sorted(versions, key=str)


def test_fixture_feed(spark):
    log = spark.createDataFrame(FEED, SCHEMA)
    assert rows(scd1(log, **ARGS)) == CURRENT
    assert rows(scd2(log, **ARGS)) == sorted(HISTORY, key=str)
    assert model(FEED) == sorted(HISTORY, key=str)


def test_arrival_order_does_not_matter(spark):
    ties = [("A", "x", "UPDATE", at(1)), ("A", "y", "UPDATE", at(1)), ("A", "w", None, at(1))]
    results = {
        (str(rows(scd1(spark.createDataFrame(log, SCHEMA), **ARGS))), str(rows(scd2(spark.createDataFrame(log, SCHEMA), **ARGS))))
        for log in (ties, ties[::-1], [ties[1], ties[2], ties[0]])
    }
    assert results == {(str([("A", "y")]), str([("A", "y", at(1), None)]))}


def test_delete_rules(spark):
    log = [
        ("A", "a", "INSERT", at(1)),
        ("A", None, "DELETE", at(2)),
        ("A", None, "DELETE", at(3)),
        ("A", "b", "INSERT", at(4)),
        ("B", "n", None, at(1)),
        ("U", "u", "UPDATE", at(1)),
    ]
    df = spark.createDataFrame(log, SCHEMA)
    assert rows(scd1(df, **ARGS)) == [("A", "b"), ("B", "n"), ("U", "u")]
    assert rows(scd2(df, **ARGS)) == [
        ("A", "a", at(1), at(2)),
        ("A", "b", at(4), None),
        ("B", "n", at(1), None),
        ("U", "u", at(1), None),
    ]


def test_rejects_name_their_reason(spark):
    log = spark.createDataFrame([(None, "x", None, at(1)), ("A", "y", None, None), ("A", "z", None, at(1))], SCHEMA)
    good, bad = split_rejects(log, ["codigo"], "event_ts")
    assert [r["descripcion"] for r in good.collect()] == ["z"]
    assert {(r["descripcion"], r["reject_reason"]) for r in bad.collect()} == {("x", "null key"), ("y", "null sequence")}
    assert rows(scd1(log, **ARGS)) == [("A", "z")]


def test_two_column_key(spark):
    log = spark.createDataFrame(
        [(1, "x", 10, "a"), (1, "y", 11, "b"), (1, "x", 12, "c"), (2, "x", 5, "d")], "a int, b string, seq long, v string"
    )
    assert rows(scd1(log, ["a", "b"], "seq")) == [(1, "x", 12, "c"), (1, "y", 11, "b"), (2, "x", 5, "d")]
    versions = scd2(log, ["a", "b"], "seq", except_columns=["seq"])
    assert (1, "x", "a", 10, 12) in rows(versions)
    assert rows(versions.where("__END_AT is null").drop("__START_AT", "__END_AT")) == rows(scd1(log, ["a", "b"], "seq", except_columns=["seq"]))


def test_collapse_unchanged(spark):
    log = [
        ("A", "x", "INSERT", at(1)),
        ("A", "x", "UPDATE", at(2)),
        ("A", None, "UPDATE", at(3)),
        ("A", None, "UPDATE", at(4)),
        ("A", "x", "DELETE", at(5)),
        ("A", "x", "UPDATE", at(6)),
    ]
    df = spark.createDataFrame(log, SCHEMA)
    want = sorted([("A", None, at(3), at(5)), ("A", "x", at(1), at(3)), ("A", "x", at(6), None)], key=str)
    assert rows(scd2(df, collapse_unchanged=True, **ARGS)) == want
    assert rows(scd2(df, collapse_unchanged=True, hot_rows=1, **ARGS)) == want


def test_arguments_are_checked(spark):
    log = spark.createDataFrame(FEED, SCHEMA)
    with pytest.raises(ValueError, match="no column other"):
        scd1(log, ["codigo"], "other")
    with pytest.raises(ValueError, match="cannot be left out"):
        scd1(log, ["codigo"], "event_ts", except_columns=["codigo"])


@pytest.mark.parametrize("collapse", [False, True])
def test_segments_of_text_sequences(spark, collapse):
    log = spark.createDataFrame(random_log(3), SCHEMA).withColumn("event_ts", F.col("event_ts").cast("string"))
    plain = scd2(log, hot_rows=None, collapse_unchanged=collapse, **ARGS)
    for hot_rows in (1, 9, 80):
        assert rows(scd2(log, hot_rows=hot_rows, collapse_unchanged=collapse, **ARGS)) == rows(plain)


def test_segments_follow_the_rows_of_their_key(spark):
    numbers = [("big", i) for i in range(5000)] + [("small", i) for i in range(60)] + [("cold", 1)]
    cuts = cut_points(spark.createDataFrame(numbers, "k string, s long"), ["k"], "s", 50)
    found = {r["k"]: len(r["__cuts"] or []) for r in cuts.collect()}
    assert set(found) == {"big", "small"} and found["big"] >= 90 and found["small"] <= 5


def test_payloads_with_maps(spark, base):
    shape = "k string, s int, m map<string,int>, op string"
    log = spark.createDataFrame([("a", 1, {"x": 1}, "U"), ("a", 1, {"y": 2}, "U"), ("a", 2, None, "U"), ("b", 1, {}, "U"), ("b", 2, {"z": 1}, "D")], shape)
    rules = dict(keys=["k"], sequence_by="s", apply_as_deletes="op = 'D'", except_columns=["s", "op"])
    assert rows(scd1(log, **rules)) == [("a", None)]
    want = [("a", None, 2, None), ("a", {"y": 2}, 1, 2), ("b", {}, 1, 2)]
    assert rows(scd2(log, **rules)) == rows(scd2(log, hot_rows=1, **rules)) == want
    assert rows(scd2(log, collapse_unchanged=True, hot_rows=1, **rules)) == want
    for scd_type, expected in ((1, [("a", None)]), (2, want)):
        target = ChangeTarget(spark, f"{base}/{scd_type}", ChangeRules(**rules), scd_type)
        target.merge(log.where("s = 2"), "w", 0)
        target.merge(log.where("s = 1"), "w", 1)
        assert rows(target.read()) == expected


def random_log(seed, size=400, keys=12):
    """A third of the rows on one key, a third of that on one instant, the rest uniform."""
    pick = random.Random(seed)
    log = []
    for _ in range(size):
        key = "hot" if pick.random() < 0.34 else f"k{pick.randrange(keys)}"
        time = at(0) if key == "hot" and pick.random() < 0.34 else at(pick.randrange(48), pick.randrange(4))
        text = pick.choice(["a", "b", "c", None])
        log.append((key, text, pick.choice(["INSERT", "UPDATE", "DELETE", None]), time))
    log += [log[0]] * (size // 3)
    pick.shuffle(log)
    return log


@pytest.mark.parametrize("hot_rows", [None, 1, 7, 60, 10_000])
def test_history_of_skewed_log(spark, hot_rows):
    log = random_log(hot_rows or 0)
    df = spark.createDataFrame(log, SCHEMA)
    versions = scd2(df, hot_rows=hot_rows, **ARGS)
    assert rows(versions) == model(log)
    current = [v[:2] for v in model(log) if v[3] is None]
    assert rows(scd1(df, **ARGS)) == rows(current_versions(versions).select("codigo", "descripcion")) == sorted(current, key=str)


@pytest.mark.parametrize("seed, batches, buckets, hot_rows", [(1, 4, 20, None), (2, 5, 1, 3), (3, 3, 2, 25)])
def test_any_split_into_batches_gives_the_rebuild(spark, base, seed, batches, buckets, hot_rows):
    log = random_log(seed, 150, 5)
    pick = random.Random(seed)
    split = [[] for _ in range(batches)]
    for row in log:
        split[pick.randrange(batches)].append(row)
    current = ChangeTarget(spark, f"{base}/one", RULES, 1, buckets)
    history = ChangeTarget(spark, f"{base}/two", RULES, 2, buckets, hot_rows)
    number = 0
    for part in [*split, split[0]]:  # the first batch arrives again at the end
        merge_into(spark.createDataFrame(part, SCHEMA), [current, history], "job", number)
        merge_into(spark.createDataFrame(part[:1], SCHEMA), [current, history], "job", number)  # replay: skipped
        number += 1
    assert rows(history.read()) == model(log)
    assert rows(current.read()) == sorted([v[:2] for v in model(log) if v[3] is None], key=str)


def test_tombstones_and_rejects_are_kept(spark, base):
    target = ChangeTarget(spark, base, RULES, 1)
    batches = [
        [("A", "new", "UPDATE", at(5)), ("A", None, "DELETE", at(6)), (None, "lost", "UPDATE", at(6))],
        [("A", "late", "UPDATE", at(4))],
    ]
    for number, batch in enumerate(batches):
        target.merge(spark.createDataFrame(batch, SCHEMA), "job", number)
    assert rows(target.read()) == []
    assert [r["reject_reason"] for r in target.rejects.read().collect()] == ["null key"]


def test_a_new_column_in_the_feed_is_taken_up(spark, base):
    target = ChangeTarget(spark, base, RULES, 2)
    target.merge(spark.createDataFrame(FEED, SCHEMA), "job", 0)
    wider = [("A", "a4", "UPDATE", at(13), "x")]
    target.merge(spark.createDataFrame(wider, SCHEMA + ", extra string"), "job", 1)
    found = {(r["descripcion"], r["extra"], r["__END_AT"]) for r in target.read().where("codigo = 'A'").collect()}
    assert found == {("a1", None, at(11)), ("a2", None, at(12)), ("a3", None, at(13)), ("a4", "x", None)}


def many_keys(spark, count, days):
    return spark.range(count * days).selectExpr(
        f"concat('K', id % {count}) codigo", "concat('d', id) descripcion", "'UPDATE' operation",
        f"timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id div {count} as int)) event_ts",
    )


def test_a_batch_of_one_key_reads_as_much_of_a_target_ten_times_as_large(spark, base, monkeypatch):
    """Rows read from the state: for an event that is newest, and for one that is late."""
    scanned, scan, read = [], ChangeTarget._scan, {}

    def counted(self, condition):
        scanned.append(scan(self, condition).count())
        return scan(self, condition)

    monkeypatch.setattr(ChangeTarget, "_scan", counted)
    for count in (300, 3000):
        target = ChangeTarget(spark, f"{base}/{count}", RULES, 2, buckets=4, bucket_rows=100)
        for number, days in enumerate((1, 40)):
            target.merge(many_keys(spark, count, days), "load", number)
        for name, day in (("new", 90), ("late", 5)):
            event = [("K7", name, "UPDATE", at(1) + timedelta(days=day, minutes=1))]
            scanned.clear()
            target.merge(spark.createDataFrame(event, SCHEMA), name, 0)
            read[name, count] = sum(scanned)
        assert target.read().count() == count * 40 + 2
    assert read["new", 3000] <= 1.5 * read["new", 300] and read["late", 3000] <= 1.5 * read["late", 300], read


def test_partitions_of_other_buckets_and_periods_stay_as_they_are(spark, base):
    target = ChangeTarget(spark, base, RULES, 2, buckets=4)
    target.merge(many_keys(spark, 20, 70), "load", 0)
    parts = lambda: {(r["f"], r["t"]) for r in target.state().selectExpr("_metadata.file_path f", "_metadata.file_modification_time t").distinct().collect()}
    before = parts()
    target.merge(spark.createDataFrame([("K7", "new", "UPDATE", at(1) + timedelta(days=80))], SCHEMA), "one", 0)
    kept, gone = before & parts(), before - parts()
    # The bucket's open versions and its versions that end in March are replaced, nothing else.
    assert len({f.rsplit("/", 1)[0] for f, _ in gone}) == 2 and all("open" in f or "2024-03" in f for f, _ in gone)
    assert len(kept) > len(gone)


def test_a_replacement_that_was_cut_off_is_made_again(spark, base, monkeypatch):
    target = ChangeTarget(spark, base, RULES, 2)
    target.merge(spark.createDataFrame(FEED[:3], SCHEMA), "job", 0)
    whole = ChangeTarget._image
    monkeypatch.setattr(ChangeTarget, "_image", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
    late = [("A", "a0", "UPDATE", at(9))]
    with pytest.raises(RuntimeError, match="lost"):
        target.merge(spark.createDataFrame(late, SCHEMA), "job", 1)
    monkeypatch.setattr(ChangeTarget, "_image", whole)
    again = ChangeTarget(spark, base, RULES, 2)
    again.merge(spark.createDataFrame(FEED[3:], SCHEMA), "other", 0)
    assert rows(again.read()) == model([*FEED, *late])


def test_a_target_with_a_name(spark, base):
    name = "dim_" + base.rsplit("-", 1)[-1]
    target = ChangeTarget(spark, base, RULES, 2, name=name, comment="it's versions", bucket_rows=2)
    target.merge(spark.createDataFrame(FEED, SCHEMA), "job", 0)
    assert rows(spark.table(name)) == rows(target.read())
    wider = spark.createDataFrame([("A", "a4", "UPDATE", at(13), {"x": 1})], SCHEMA + ", extra map<string,int>")
    target.merge(wider, "job", 1)
    assert rows(spark.table(name)) == rows(target.read()) and "extra" in spark.table(name).columns
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe table extended {name}").collect()}
    assert about["Comment"] == "it's versions"


def test_views_agree_when_the_lookup_is_too_large_to_broadcast(spark):
    loans = spark.range(2000).selectExpr(
        "id prestamo_id", "id cliente_id", "if(id % 3 = 0, 'P0', if(id % 3 = 1, null, concat('P', id))) producto_codigo",
        "'V' estado_prestamo_codigo", "1.0 monto_original", "1.0 tasa_anual", "1 numero_cuotas",
        "current_date() fecha_desembolso", "timestamp_ntz'2024-01-01' fec_modificacion",
        "timestamp_ntz'2024-01-01' __START_AT", "if(id % 2 = 0, timestamp_ntz'2024-02-01', null) __END_AT",
    )
    products = spark.range(0, 2000, 2).selectExpr("concat('P', id) codigo", "concat('d', id) descripcion")
    small = [rows(view(loans, products)) for view in (loan_history, loan_current)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = [rows(view(loans, products)) for view in (loan_history, loan_current)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert small == large and [len(s) for s in small] == [2000, 1000]


@pytest.mark.parametrize("kind", ["string", "date", "decimal(20,3)", "timestamp"])
def test_incremental_history_for_other_sequence_types(spark, base, kind):
    log = spark.range(60).selectExpr("id % 3 k", f"cast(date_add(date'2024-01-01', cast(id * 7 % 60 as int)) as date) d", "id v")
    column = {"decimal(20,3)": "cast(datediff(d, date'2024-01-01') as decimal(20,3))"}.get(kind, f"cast(d as {kind})")
    log = log.selectExpr("k", f"{column} as seq", "v")
    target = ChangeTarget(spark, base, ChangeRules(["k"], "seq"), 2)
    for number, low in enumerate((40, 0, 20)):
        target.merge(log.where(f"v >= {low} and v < {low + 20}"), "job", number)
    assert rows(target.read()) == rows(scd2(log, ["k"], "seq"))
