"""Record mapping, typed projection, and streaming against batch."""

import pytest

from heliograph.operators import ingest, typed
from heliograph.plans.requests import InvalidRequest, check_predicate
from heliograph.sources import schema as s
from heliograph.streaming import sinks

V = dict.fromkeys(f.name for f in s.VALUE)
ALL_TYPES = [typed.TypedField("traces", "otel_traces", "span", k, t, f"av_{k}", f"as_{k}") for k, t in (("name", "string"), ("complete", "boolean"), ("count", "int64"))]


def entries(**kw):
    kinds = {bool: "bool_value", int: "int_value", str: "string_value", float: "double_value", bytes: "bytes_value"}
    return [{"key": k, "value": {**V, kinds[type(v)]: v}} for k, v in kw.items()]


@pytest.mark.parametrize("attrs, want", [
    (entries(name="cart", complete=False, count=7), [("cart", 3), (False, 3), (7, 3)]),
    (None, [("", 1), (False, 1), (0, 1)]),
    (entries(name="", complete="false", count="9223372036854775808"), [("", 2), (False, 4), (0, 4)]),
    (entries(count=1) + entries(count=2), [("", 1), (False, 1), (0, 4)]),
])
def test_typed_projection(spark, attrs, want):
    df = spark.createDataFrame([(attrs,)], s._struct(("attributes", s.ATTRS)))
    row = typed.project_typed(df, ALL_TYPES, {"span": "attributes"}).first()
    assert [(row[f.value_column], row[f.status_column]) for f in ALL_TYPES] == want


def test_log_row(spark):
    rec = {"timestamp_unix_nano": 0, "observed_time_unix_nano": 1700000000123456789, "trace_id": "t", "span_id": "s", "trace_flags": 257, "severity_text": "INFO", "severity_number": 265, "body": {**V, "json_value": '{"job":"refresh"}'}, "event_name": None, "resource": None, "scope": None, "attributes": entries(a=1) + entries(a=2)}
    df = ingest.logs(spark.createDataFrame([rec], s.LOG_RECORD))
    row = s.conform(df, s.LOGS).first()
    assert (row.timestamp_nanos, row.TraceFlags, row.SeverityNumber, row.Body, row.ServiceName) == (1700000000123456789, 1, 9, '{"job":"refresh"}', "")
    assert row.LogAttributes == {"a": "2"}


def test_values_as_text(spark):
    df = spark.createDataFrame([(entries(a="x", b=True, c=5, d=1.5, e=b"hi"),)], s._struct(("attributes", s.ATTRS)))
    assert df.select(ingest.attribute_map(df.attributes).alias("m")).first().m == {"a": "x", "b": "true", "c": "5", "d": "1.5", "e": "aGk="}


def test_enum_labels(spark):
    df = spark.createDataFrame([(x,) for x in ("internal", "server", "ok", None)], "x string")
    assert [r.y for r in df.select(ingest.enum_label(df.x, "unset").alias("y")).collect()] == ["Internal", "Server", "Ok", "Unset"]


def test_violations_split_off(spark):
    df = spark.createDataFrame([(-1, "a"), (1, "b"), (None, "c")], "timestamp_nanos long, x string")
    good, bad = ingest.split_violations(df)
    assert [r.x for r in good.collect()] == ["b"] and sorted(r.x for r in bad.collect()) == ["a", "c"]


def test_schema_mismatch_fails(spark):
    with pytest.raises(s.SchemaMismatch):
        s.conform(spark.createDataFrame([(1,)], "timestamp_nanos long"), s.LOGS)


@pytest.mark.parametrize("kind, op, value", [("string", "starts-with", ""), ("string", "gte", "a"), ("int64", "eq", True), ("int64", "gte", 2**63), ("boolean", "eq", 1)])
def test_predicates_are_closed(kind, op, value):
    with pytest.raises(InvalidRequest):
        check_predicate(kind, op, value)


def test_declaration_conflicts(spark):
    rows = [("traces", "otel_traces", "span", "k", "string", "a"), ("traces", "otel_traces", "span", "k", "string", "b"), ("logs", "otel_logs", "log", "j", "int64", "a"), ("logs", "otel_logs", "log", "j", "string", "b"), ("logs", "otel_logs", "resource", "z", "string", "a")]
    good, bad = typed.declarations(spark.createDataFrame(rows, typed.DECLARATION))
    assert bad.count() == 1
    merged, conflicts = typed.merge_declarations(good)
    assert [r.key for r in merged.collect()] == ["k"] and [r.key for r in conflicts.collect()] == ["j"]
    assert typed.fields(merged)[0].value_column.startswith("av_traces_span_k_")


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    rec = {"name": "op", "kind": "server", "start_time_unix_nano": 10**18, "end_time_unix_nano": 10**18 + 5, "span_context": {"trace_id": "t1", "span_id": "s1", "trace_state": None}, "parent_span_id": None, "resource": None, "scope": None, "attributes": None, "events": None, "links": None, "status": None}
    source = str(tmp_path / "in")
    batch = spark.createDataFrame([rec, {**rec, "start_time_unix_nano": -5}], s.SPAN_RECORD)
    batch.write.json(source)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):
        stream = sinks.read_records(spark, source, s.SPAN_RECORD, stream=True)
        sinks.span_stream(stream, out, check).trigger(availableNow=True).start().awaitTermination(120)
        got = spark.read.parquet(f"{out}/otel_traces")
        assert [(r.TraceId, r.Duration) for r in got.collect()] == [("t1", 5)]
    assert spark.read.parquet(f"{out}/otel_traces_trace_id_ts").count() == 1
    direct = ingest.split_violations(ingest.spans(sinks.read_records(spark, source, s.SPAN_RECORD)))[0]
    assert direct.count() == 1
