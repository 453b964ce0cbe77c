"""OTLP JSON, typed columns through the sinks, bindings, discovery, statuses, stored types, sketches and reconciliation."""

import json

import pytest
from pyspark.sql import functions as F

from heliograph.operators import cumulative, ingest, reports, series, typed
from heliograph.plans.requests import InvalidRequest, Series
from heliograph.sources import otlp, schema as s
from heliograph.streaming import sinks

PLACES = [("traces", "otel_traces", "span"), ("traces", "otel_traces", "resource"), ("traces", "otel_traces", "scope"), ("logs", "otel_logs", "log")]
PLACES += [("metrics", f"otel_metrics_{k}", x) for k in ("gauge", "sum", "histogram") for x in ("point", "resource", "scope")]


def field(signal, table, location, key="tier", kind="string"):
    stem = f"{table.removeprefix('otel_')}_{location}_{key}"
    return typed.TypedField(signal, table, location, key, kind, f"av_{stem}", f"as_{stem}")


FIELDS = [field(*p) for p in PLACES] + [field("traces", "otel_traces", "span", "size", "int64")]


def attr(key, **value):
    return {"key": key, "value": value}


RESOURCE = {"attributes": [attr("service.name", stringValue="api"), attr("tier", stringValue="gold")]}
SCOPE = {"name": "lib", "version": "1", "attributes": [attr("tier", stringValue="")]}
SPAN = {
    "traceId": "t1", "spanId": "s1", "traceState": "a=1,b=2", "name": "op", "kind": 2, "startTimeUnixNano": "1700000000000000001", "endTimeUnixNano": "1700000000000000009",
    "attributes": [attr("tier", intValue="5"), attr("size", intValue="9007199254740993"), attr("list", arrayValue={"values": [{"stringValue": 'a"b'}, {"intValue": "1"}]}), attr("map", kvlistValue={"values": [attr("x", boolValue=True)]}), attr("raw", bytesValue="aGk=")],
    "events": [{"timeUnixNano": "1700000000000000005", "name": "e", "attributes": [attr("n", doubleValue=1.5)]}], "links": [{"traceId": "t0", "spanId": "s0", "traceState": "", "attributes": []}], "status": {"code": 2, "message": "bad"},
}
LOG = {"timeUnixNano": "0", "observedTimeUnixNano": "1700000000000000007", "traceId": "t1", "spanId": "s1", "flags": 257, "severityText": "WARN", "severityNumber": 13, "body": {"stringValue": "hello"}, "attributes": [attr("tier", stringValue="x")]}
POINT = {"startTimeUnixNano": "1700000000000000000", "timeUnixNano": "1700000001000000000", "attributes": [attr("tier", stringValue="p")]}
METRICS = [
    {"name": "g", "unit": "ms", "gauge": {"dataPoints": [{**POINT, "asDouble": 1.5}]}},
    {"name": "c", "unit": "1", "sum": {"aggregationTemporality": 2, "isMonotonic": True, "dataPoints": [{**POINT, "asInt": "7"}]}},
    {"name": "h", "unit": "ms", "histogram": {"aggregationTemporality": "AGGREGATION_TEMPORALITY_DELTA", "dataPoints": [{**POINT, "count": "3", "sum": 6.0, "bucketCounts": ["1", "2"], "explicitBounds": [10.0], "min": 1.0, "max": 3.0}]}},
]


@pytest.fixture(scope="module")
def sent(tmp_path_factory):
    root = tmp_path_factory.mktemp("otlp")
    out = {}
    for signal, body in {
        "spans": {"resourceSpans": [{"resource": RESOURCE, "scopeSpans": [{"scope": SCOPE, "spans": [SPAN, {**SPAN, "spanId": "s2", "startTimeUnixNano": "-5"}]}]}]},
        "logs": {"resourceLogs": [{"resource": RESOURCE, "scopeLogs": [{"scope": SCOPE, "logRecords": [LOG]}]}]},
        "metrics": {"resourceMetrics": [{"resource": RESOURCE, "scopeMetrics": [{"scope": SCOPE, "metrics": METRICS}]}]},
    }.items():
        (root / signal).mkdir()
        (root / signal / "a.json").write_text(json.dumps(body) + "\n")
        out[signal] = str(root / signal)
    return out


def test_otlp_spans(spark, sent):
    row = ingest.spans(otlp.read_spans(spark, sent["spans"])).where("SpanId = 's1'").first()
    assert (row.SpanKind, row.StatusCode, row.StatusMessage, row.TraceState, row.Duration, row.ServiceName) == ("Server", "Error", "bad", "a=1,b=2", 8, "api")
    assert row.SpanAttributes == {"tier": "5", "size": "9007199254740993", "list": '["a\\"b",1]', "map": '{"x":true}', "raw": "aGk="}
    assert (row.events_name, row.events_attributes, row.links_trace_id) == (["e"], [{"n": "1.5"}], ["t0"])


def test_otlp_logs_and_metrics(spark, sent):
    row = s.conform(ingest.logs(otlp.read_logs(spark, sent["logs"])), s.LOGS).first()
    assert (row.timestamp_nanos, row.TraceFlags, row.Body, row.SeverityText) == (1700000000000000007, 1, "hello", "WARN")
    records = otlp.read_metrics(spark, sent["metrics"])
    g = s.conform(ingest.gauges(ingest.metric_points(records, "gauge")), s.GAUGE).first()
    c = s.conform(ingest.sums(ingest.metric_points(records, "sum")), s.SUM).first()
    h = s.conform(ingest.histograms(ingest.metric_points(records)), s.HISTOGRAM).first()
    assert (g.MetricName, g.Value, c.Value, c.AggregationTemporality, c.IsMonotonic) == ("g", 1.5, 7.0, 2, True)
    assert (h.AggregationTemporality, int(h.Count), [int(x) for x in h.BucketCounts], h.ExplicitBounds, h.Min, h.Max) == (1, 3, [1, 2], [10.0], 1.0, 3.0)


def test_streamed_typed_rows_equal_batch(spark, sent, tmp_path):
    out = str(tmp_path / "out")
    streams = {"spans": (otlp.read_spans, sinks.span_stream), "logs": (otlp.read_logs, sinks.log_stream), "metrics": (otlp.read_metrics, sinks.metric_stream)}
    for signal, (read, sink) in streams.items():
        for _ in range(2):  # a restart adds nothing
            sink(read(spark, sent[signal], stream=True), out, str(tmp_path / f"check-{signal}"), FIELDS).trigger(availableNow=True).start().awaitTermination(120)
    own = {t: [f for f in FIELDS if f.table == t] for t in s.TABLES}
    records = otlp.read_metrics(spark, sent["metrics"])
    direct = {
        "otel_traces": ingest.split_violations(ingest.spans(otlp.read_spans(spark, sent["spans"]), fields=own["otel_traces"]))[0], "otel_logs": ingest.logs(otlp.read_logs(spark, sent["logs"]), fields=own["otel_logs"]),
        **{f"otel_metrics_{k}": f(ingest.metric_points(records, k), fields=own[f"otel_metrics_{k}"]) for k, f in (("gauge", ingest.gauges), ("sum", ingest.sums), ("histogram", ingest.histograms))},
    }
    for table, want in direct.items():
        got = spark.read.parquet(f"{out}/{table}").select(want.columns)
        assert want.count() > 0 and reports.difference(want, got).count() == 0, table
    row = direct["otel_traces"].first()
    assert (row.av_traces_span_tier, row.as_traces_span_tier, row.av_traces_span_size, row.as_traces_span_size) == ("", 4, 9007199254740993, 3)
    assert (row.av_traces_resource_tier, row.as_traces_resource_tier, row.as_traces_scope_tier) == ("gold", 3, 2)
    assert direct["otel_metrics_histogram"].first().av_metrics_histogram_point_tier == "p" and direct["otel_metrics_sum"].first().as_metrics_sum_scope_tier == 2
    bad = spark.read.parquet(f"{out}/rejected/otel_traces").collect()
    assert [(r.SpanId, r.violations) for r in bad] == [("s2", ["timestamp_nanos_domain"])]


def test_keys_and_bindings():
    traces = [f for f in FIELDS if f.table == "otel_traces"]
    code = lambda call: pytest.raises(InvalidRequest, call).value.code
    assert typed.resolve(traces, "size").key == "size" and typed.resolve(traces, "tier", "scope").location == "scope"
    assert code(lambda: typed.resolve(traces, "tier")) == "ambiguous_typed_key" and code(lambda: typed.resolve(traces, "no")) == "unknown_typed_key"
    assert code(lambda: typed.resolve(traces, " ")) == "invalid_typed_key" and code(lambda: typed.resolve(traces, "tier", "body")) == "invalid_typed_location"
    assert code(lambda: typed.resolve([traces[1]], "tier", spans_only=True)) == "typed_location_required"
    b = typed.binding_of(traces[-1])
    assert typed.bound_field(traces, b) == traces[-1]
    given = dict(vars(b))
    assert typed.bound_field(traces, {k: v for k, v in given.items() if k != "attribute_location"}) == traces[-1]
    assert code(lambda: typed.bound_field(traces, {**given, "attribute_type": "string"})) == "stale_typed_schema_binding"
    assert code(lambda: typed.bound_field(traces, b, version=2)) == "stale_typed_schema_binding"
    assert code(lambda: typed.bound_field(traces, {**given, "extra": 1})) == "invalid_typed_schema_binding" and code(lambda: typed.bound_field(traces, {**given, "manifest_version": True})) == "invalid_typed_schema_binding"


def test_binding_ids_are_the_declared_ones(spark):
    row = typed.physical_names(spark.createDataFrame([("traces", "otel_traces", "span", "size", "int64", "x")], typed.DECLARATION)).first()
    assert row.attribute_id == typed.binding_of(FIELDS[-1]).field_id


def test_discovered_fields(spark):
    for kind in ("gauge", "sum", "histogram"):
        rows = typed.typed_fields(spark, FIELDS, f"otel_metrics_{kind}").collect()
        assert {(r.metric_kind, r.location, r.key, tuple(r.operators)) for r in rows} == {(kind, x, "tier", ("eq", "starts-with", "contains")) for x in ("point", "resource", "scope")}


def test_inferred_evidence(spark):
    rows = [(False, "known", ["int64"], 1), (True, "known", ["int64"], 1), (False, "conflicting", ["int64"], 1), (False, "invalid", [], 1), (False, "unknown", [], 1), (False, "known", ["int64", "string"], 1), (False, "known", ["double"], 1), (False, "known", ["string"], 2)]
    got = typed.inferred(spark.createDataFrame(rows, "dynamic boolean, state string, types array<string>, targets int")).collect()
    assert [r.code for r in got] == [None, "dynamic-key", "conflicting", "invalid", "unknown", "conflicting", "unsupported-type", "ambiguous-target"]


def test_unknown_status_fails(spark):
    f = FIELDS[-1]
    df = spark.createDataFrame([(1, 5, 9, {"a": "b"})], f"timestamp_nanos long, {f.value_column} long, {f.status_column} int, SpanAttributes map<string,string>")
    with pytest.raises(Exception, match="unknown_typed_status"):
        typed.typed_coverage(df, f, 0, 10).collect()


def test_stored_types_are_checked(spark):
    df = spark.createDataFrame([(1, "x")], "Count long, Sum string")
    request = Series("cumulative-histogram", "m", 0, 10, ["count"], temporality="cumulative")
    with pytest.raises(cumulative.TelemetryViolation, match="type_drift"):
        cumulative.histogram_series(df, request)


def test_sketched_percentiles(spark):
    df = spark.range(1, 10_001).select(F.lit("m").alias("MetricName"), F.col("id").alias("time_unix"), F.col("id").cast("double").alias("Value"))
    row = series.metric_series(df, Series("gauge", "m", 0, 2 * 10**13, ["p50", "p95", "p99"])).first()
    assert abs(row.p50 - 5000) <= 100 and abs(row.p95 - 9500) <= 100 and abs(row.p99 - 9900) <= 100
    spans = df.select(F.lit("a").alias("SpanName"), (F.col("Value") * 1e6).cast("long").alias("Duration"))
    assert abs(reports.dashboard(spans).first().p95_ms - 9500) <= 100


def test_digest_sees_every_column(spark):
    rows = [(1, "a", {"x": "1", "y": "2"}), (2, None, {})]
    df = spark.createDataFrame(rows, "n long, t string, m map<string,string>")
    same = spark.createDataFrame(rows[::-1], df.schema).withColumn("m", F.map_from_entries(F.reverse(F.map_entries("m"))))
    first = reports.digest(df, "d").first()
    assert first == reports.digest(same, "d").first()
    for n in ("n", "t", "m"):
        changed = df.withColumn(n, F.when(F.col("n") == 1, F.lit({"n": 7, "t": "b"}.get(n, None)) if n != "m" else F.create_map(F.lit("x"), F.lit("3"))).otherwise(F.col(n)))
        assert reports.digest(changed, "d").first().digest != first.digest
    assert sorted((r.side, r.n) for r in reports.difference(df, df.where("n = 1").unionAll(df.where("n = 1"))).collect()) == [("read", 1), ("written", 2)]
