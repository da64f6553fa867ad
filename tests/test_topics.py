"""Reader options, payloads in a registry envelope, and the topic job."""

import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from tidemark.functions.payloads import payload_names, split_envelope
from tidemark.plans.jobs import decode_topic, ingest_topic, replay_dead_letters
from tidemark.sources.offsets import DataLossError, check_offsets, offset_gaps, offset_runs, resume_offsets, starting_offsets
from tidemark.sources.topics import TOPIC_SCHEMA, default_subject, kafka_options, read_topic_files, subject_schemas
from tidemark.streaming.sinks import drain
from tidemark.streaming.tables import AuditedTable

FIELDS = T.StructType().add("t", "string").add("n", "long").add("d", "date").add("x", "double").add("at", "timestamp")
ONE = FIELDS.json()
TWO = T.StructType([*FIELDS.fields, T.StructField("more", T.StringType())]).json()
REGISTRY = "subject string, schema_id int, schema_json string"


def payload(text, number, day="2024-01-02", amount=1.0, at="2024-01-02T03:04:05.678Z", more=None, schema_id=1):
    body = {"t": text, "n": number, "d": day, "x": amount, "at": at} | ({"more": more} if schema_id == 2 else {})
    return b"\x00" + schema_id.to_bytes(4, "big") + json.dumps(body, ensure_ascii=False).encode()


def messages(spark, values):
    rows = [(f"k{i}".encode(), v, "pagos", 0, i, datetime(2024, 1, 1), 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, TOPIC_SCHEMA)


def decoded(spark, values, schemas, mode="FAILFAST"):
    events = decode_topic(messages(spark, values), schemas, "dev", mode=mode, keep_undecoded=True, payload_format="json")
    return events.orderBy("kafka_offset").collect()


def test_payload_values(spark):
    rows = decoded(spark, [payload("", -1, "1969-12-31", -0.5), payload("año ☃", 2**62, amount=1e300), payload(None, None, None, None, None), None], {1: ONE})
    assert [r["t"] for r in rows] == ["", "año ☃", None, None]
    assert [r["n"] for r in rows] == [-1, 2**62, None, None]
    assert rows[0]["d"] == date(1969, 12, 31) and [r["x"] for r in rows] == [-0.5, 1e300, None, None]
    assert rows[1]["at"].microsecond == 678_000 and [r["undecoded"] for r in rows] == [None] * 4
    assert {r["source_environment"] for r in rows} == {"dev"} and [r["kafka_key"] for r in rows] == ["k0", "k1", "k2", "k3"]


def test_two_schema_versions_in_one_batch(spark):
    values = [payload("a", 1), payload("b", 2, more="m", schema_id=2), payload("c", 3, schema_id=2)]
    rows = decoded(spark, values, {1: ONE, 2: TWO})
    assert [(r["t"], r["more"]) for r in rows] == [("a", None), ("b", "m"), ("c", None)]


HEAD = b"\x00\x00\x00\x00\x01"
BROKEN = [
    payload("abc", 1)[:9], b"\x07" + payload("abc", 1)[1:], payload("abc", 1)[:3], b"", HEAD, HEAD + b"\xff\xfe", HEAD + b"[1]",
    payload("abc", "no number"), payload("abc", 1, "no day"), b"\x07\xff\xff\xff\xff\xff", b"\x00\xff\xff\xff\xff\xff",
]


@pytest.mark.parametrize("bad", BROKEN)
def test_failfast_raises(spark, bad):
    with pytest.raises(Exception, match="does not decode|MALFORMED_RECORD"):
        decoded(spark, [payload("a", 1), bad], {1: ONE})


def test_permissive_keeps_the_raw_value(spark):
    good = payload("a", 1)
    rows = decoded(spark, [good, *BROKEN, good], {1: ONE}, "PERMISSIVE")
    assert [r["t"] for r in rows] == ["a", *[None] * len(BROKEN), "a"]
    assert [None if r["undecoded"] is None else bytes(r["undecoded"]) for r in rows] == [None, *BROKEN, None]


def test_unknown_schema_id_fails_in_both_modes(spark):
    for mode in ("FAILFAST", "PERMISSIVE"):
        with pytest.raises(Exception, match="unknown schema id 2"):
            decoded(spark, [payload("a", 1, schema_id=2)], {1: ONE}, mode)


def test_envelope_is_split_without_python(spark):
    split = split_envelope(messages(spark, [payload("a", 1, schema_id=70000), None])).orderBy("offset")
    assert [(r["magic"], r["schema_id"]) for r in split.collect()] == [(0, 70000), (None, None)]


def test_schema_checks(spark):
    avro = json.dumps({"type": "record", "name": "R", "fields": [{"name": "kafka_offset", "type": "long"}]})
    assert payload_names(avro) == ["kafka_offset"] and payload_names(ONE) == ["t", "n", "d", "x", "at"]
    with pytest.raises(ValueError, match="must be a record"):
        payload_names('{"type": "string"}')
    with pytest.raises(ValueError, match="kafka_offset"):
        decode_topic(messages(spark, []), {1: avro}, "dev")
    with pytest.raises(ValueError, match="unknown mode"):
        decoded(spark, [], {1: ONE}, "DROPMALFORMED")
    with pytest.raises(ValueError, match="unknown format"):
        decode_topic(messages(spark, []), {1: ONE}, "dev", payload_format="xml")


def test_kafka_options():
    options = kafka_options(
        "h:1", "pagos", "latest", 5000, True, "SASL_SSL", "SCRAM-SHA-256", username="u", password="p", ca_certificate="PEM"
    )
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "pagos",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5000",
        "failOnDataLoss": "true",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-256",
        "kafka.sasl.jaas.config": 'org.apache.kafka.common.security.scram.ScramLoginModule required username="u" password="p";',
        "kafka.ssl.truststore.type": "PEM",
        "kafka.ssl.truststore.certificates": "PEM",
    }
    assert kafka_options("h:1", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in kafka_options("h:1", "t")
    for wrong in (("", "t"), ("h:1", "")):
        with pytest.raises(ValueError):
            kafka_options(*wrong)
    with pytest.raises(ValueError, match="username"):
        kafka_options("h:1", "t", sasl_mechanism="PLAIN")


def registry(spark, *texts):
    return spark.createDataFrame([("pagos-value", i + 1, text) for i, text in enumerate(texts)], REGISTRY)


def test_subjects(spark):
    assert default_subject("pagos") == "pagos-value"
    assert subject_schemas(registry(spark, ONE, TWO), "pagos-value") == {1: ONE, 2: TWO}
    with pytest.raises(ValueError, match="no schema"):
        subject_schemas(registry(spark, ONE), "other")


def test_new_schema_version_stops_the_job_and_a_rerun_resumes(spark, base):
    def land(n, values):
        messages(spark, values).coalesce(1).write.parquet(f"{base}/in/{n}")

    def run(known):
        stream = read_topic_files(spark, f"{base}/in/*", 1)
        drain(ingest_topic(stream, known, "pagos", "dev", f"{base}/cp", path=f"{base}/bronze", key_alias="user_key", payload_format="json"))
        return AuditedTable(spark, f"{base}/bronze").read()

    land(0, [payload("a", 1)])
    assert run(registry(spark, ONE)).count() == 1
    land(1, [payload("b", 2, more="m", schema_id=2), payload("c", 2)])
    with pytest.raises(Exception, match="unknown schema id 2"):
        run(registry(spark, ONE))
    found = run(registry(spark, ONE, TWO))
    assert sorted((r["t"], r["more"]) for r in found.collect()) == [("a", None), ("b", "m"), ("c", None)]
    assert run(registry(spark, ONE, TWO)).count() == 3


def test_topic_into_a_catalog_table(spark, base):
    messages(spark, [payload("a", 1)]).write.parquet(f"{base}/in")
    name = "bronze_" + base.rsplit("-", 1)[-1]
    job = ingest_topic(
        read_topic_files(spark, f"{base}/in"), registry(spark, ONE), "pagos", "dev", f"{base}/cp", target=name, path=f"{base}/t", payload_format="json"
    )
    assert job.name == "bronze_pagos_kafka"
    drain(job)
    assert spark.table(name).columns == [
        "t", "n", "d", "x", "at", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
        "kafka_timestamp_type", "kafka_key", "ingested_at", "source_environment",
    ]
    assert spark.table(name).count() == 1
    with pytest.raises(ValueError, match="unknown trigger"):
        ingest_topic(
            read_topic_files(spark, f"{base}/in"), registry(spark, ONE), "pagos", "dev", f"{base}/cp2", path=f"{base}/x", trigger="once", payload_format="json"
        )


OFFSETS = "topic string, partition int, offset long"


def plain_runs(rows):
    found = []
    for t, p in sorted({r[:2] for r in rows}):
        offsets = sorted({o for a, b, o in rows if (a, b) == (t, p)})
        for o in offsets:
            if found and found[-1][:2] == (t, p) and found[-1][3] + 1 == o:
                found[-1] = (t, p, found[-1][2], o)
            else:
                found.append((t, p, o, o))
    return found


@pytest.mark.parametrize("block", [1, 7, 50, 10**6])
def test_runs_and_gaps_of_offsets(spark, block):
    pick = random.Random(block)
    rows = [(t, p, o) for t in ("a", "b") for p in range(3) for o in range(20, 200) if pick.random() < (0.9, 1.0, 0.3)[p]]
    df = spark.createDataFrame([*rows, *rows[:40], (None, 0, 1), ("a", None, 1), ("a", 0, None)], OFFSETS).repartition(3)
    runs = offset_runs(df, block)
    expected = plain_runs(rows)
    assert sorted(tuple(r[c] for c in ("topic", "partition", "first_offset", "last_offset")) for r in runs.collect()) == expected
    holes = [(*a[:2], a[3] + 1, b[2] - 1, b[2] - a[3] - 1) for a, b in zip(expected, expected[1:]) if a[:2] == b[:2]]
    assert sorted(map(tuple, offset_gaps(runs).collect())) == holes


def test_lost_offsets_stop_the_job_or_are_told(spark):
    runs = offset_runs(spark.createDataFrame([("a", 0, o) for o in (5, 6, 9)] + [("a", 1, 3)], OFFSETS))
    with pytest.raises(DataLossError, match="topic a partition 0: offsets 7 to 8"):
        check_offsets(runs)
    assert check_offsets(runs, fail_on_data_loss=False).count() == 1
    assert check_offsets(runs.where("partition = 1")).count() == 0
    assert starting_offsets(resume_offsets(runs)) == '{"a": {"0": 10, "1": 4}}'
    assert starting_offsets(resume_offsets(runs, skip_gaps=False)) == '{"a": {"0": 7, "1": 4}}'


def test_dead_letters_are_replayed_once(spark, base):
    schemas = {1: T.StructType().add("x", "integer").json(), 2: T.StructType().add("x", "integer").add("y", "string").json()}
    registry = spark.createDataFrame([("t-value", i, text) for i, text in schemas.items()], "subject string, schema_id int, schema_json string")

    def message(offset, schema_id, body):
        value = b"\x00" + schema_id.to_bytes(4, "big") + body
        return (b"k", value, "t", 0, offset, datetime(2024, 1, 1), 0)

    rows = [message(0, 1, b'{"x": 1}'), message(1, 2, b'{"x": 2, "y": "b"}'), message(2, 3, b'{"x": 3}')]
    spark.createDataFrame(rows, TOPIC_SCHEMA).write.parquet(f"{base}/in")
    settings = {"path": f"{base}/bronze", "dead_letters": f"{base}/dead", "payload_format": "json"}
    for _ in range(2):
        drain(ingest_topic(read_topic_files(spark, f"{base}/in"), registry.where("schema_id = 1"), "t", "dev", f"{base}/cp", **settings))
    bronze = AuditedTable(spark, f"{base}/bronze")
    assert [r["x"] for r in bronze.read().collect()] == [1]
    assert replay_dead_letters(registry.where("schema_id = 1"), "t", "dev", **settings) == 0
    assert [replay_dead_letters(registry, "t", "dev", **settings) for _ in range(2)] == [1, 0]
    assert sorted((r["x"], r["y"]) for r in bronze.refresh().read().collect()) == [(1, None), (2, "b")]
    dead = AuditedTable(spark, f"{base}/dead").read()
    assert sorted(r["schema_id"] for r in dead.collect()) == [2, 3]
    with pytest.raises(ValueError, match="no target"):
        ingest_topic(read_topic_files(spark, f"{base}/in"), registry, "t", "dev", base, target="x", dead_letters=base)


def test_a_body_is_parsed_once(spark, capsys):
    messages = spark.createDataFrame([], TOPIC_SCHEMA)
    decode_topic(messages, {1: T.StructType().add("x", "integer").json()}, "dev", payload_format="json").explain("extended")
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("from_json") == 1
