"""Streams: differencing with state, windows with late rows, commit markers, lines that are no requests."""

import json

import pytest
from pyspark.sql import functions as F

from heliograph.operators import cumulative, ingest, series
from heliograph.plans import catalog as q
from heliograph.plans.requests import Series
from heliograph.sources import adapters as a, otlp, schema as s
from heliograph.streaming import commits, differencing, sinks, windows

DATA = "/root/testdata/sf0.001"
COUNTER = Series("cumulative-counter", "events.click", q.START, q.END, ["increase", "rate"], ["service-name"], "1h", None, temporality="cumulative", monotonic=True, limits=q.ALL)
HISTOGRAM = Series("cumulative-histogram", "latency.view", q.START, q.END, ["count", "sum", "avg", "p50"], ["service-name"], limit=None, temporality="cumulative", limits=q.ALL)
COLUMNS = {*cumulative.HISTOGRAM_KEY, *cumulative.MAPS, "time_unix", "start_time_unix", "Value", "AggregationTemporality", "IsMonotonic", "Count", "Sum", "BucketCounts", "ExplicitBounds", "Flags", "Min", "Max"}


def rounded(df):
    r = lambda x: round(x, 5) if isinstance(x, float) else tuple(map(r, x)) if isinstance(x, (list, tuple)) else x
    return sorted((tuple(r(x) for x in row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("request_, rows, intervals, sums, batch", [
    (COUNTER, lambda spark: a.all_sums(spark, DATA), differencing.counter_intervals, cumulative.counter_sums, cumulative.counter_series),
    (HISTOGRAM, lambda spark: a.histograms(spark, DATA, True), differencing.histogram_intervals, cumulative.histogram_sums, cumulative.histogram_series),
], ids=["counter", "histogram"])
def test_three_batches_and_restarts_equal_one(spark, tmp_path, request_, rows, intervals, sums, batch):
    df = rows(spark)
    df = df.select([c for c in df.columns if c in COLUMNS]).persist()
    low, high = df.agg(F.percentile("time_unix", F.lit(0.3)), F.percentile("time_unix", F.lit(0.7))).first()
    at = F.col("time_unix")
    for part in (at < low, (at >= low) & (at < high), at >= high):  # the query is started anew for each file
        df.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        differencing.store_intervals(intervals(stream, request_), request_, str(tmp_path / "out"), str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(120)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.where("code IS NOT NULL").count() == 0
    got, want = rounded(sums(stored, request_)), rounded(batch(df, request_))
    assert len(want) > 3 and got == want


def snapshots(spark, points):
    base = a.all_sums(spark, DATA).limit(1).select([c for c in a.all_sums(spark, DATA).columns if c in COLUMNS])
    rows = [(int(t), int(start), float(v)) for start, t, v in points]
    times = spark.createDataFrame(rows, "t long, s long, v double")
    return base.crossJoin(times).withColumns({"time_unix": F.col("t"), "start_time_unix": F.col("s"), "Value": F.col("v"), "MetricName": F.lit("m"), "AggregationTemporality": F.lit(2)}).select(base.columns)


def run(spark, root, points, expiry_ms=None):
    """One more file for the stream, and the query started for it."""
    request = Series("cumulative-counter", "m", 0, q.END, ["increase"], limit=None, temporality="cumulative", monotonic=True, limits=q.ALL)
    df = snapshots(spark, points)
    df.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
    query = differencing.store_intervals(differencing.counter_intervals(stream, request, expiry_ms), request, f"{root}/out", f"{root}/check").trigger(availableNow=True).start()
    query.awaitTermination(120 if expiry_ms is None else 25)  # with expiry Spark goes on making batches without rows
    query.stop()
    return request, spark.read.parquet(f"{root}/out")


def test_late_rows_are_told_and_change_nothing(spark, tmp_path):
    run(spark, tmp_path, [(0, 10, 5), (0, 20, 9)])
    request, out = run(spark, tmp_path, [(0, 15, 7), (0, 20, 9), (0, 30, 12)])
    assert sorted((r.t // 10**9, r.code or "", r.used) for r in out.collect()) == [(10, "", True), (15, "late_row", False), (20, "", True), (20, "ambiguous_order", False), (30, "", True)]
    assert cumulative.counter_sums(out.where("code IS NULL"), request).first().increase == 12.0
    with pytest.raises(cumulative.TelemetryViolation, match="ambiguous_order"):
        cumulative.counter_sums(out, request)


def test_forgotten_streams_start_from_a_base(spark, tmp_path):
    import time

    run(spark, tmp_path, [(0, 10, 5)], expiry_ms=1)
    time.sleep(0.2)
    request, out = run(spark, tmp_path, [(0, 100, 9), (0, 110, 11)], expiry_ms=1)
    # What came between 10 and 100 is not known any more and not counted twice.
    assert sorted((r.t // 10**9, r.used, r.Value if r.used else None) for r in out.where("t > 50000000000").collect()) == [(100, False, None), (110, True, 2.0)]


def points(spark, rows):
    kind = "time_unix long, Value double, ServiceName string"
    return spark.createDataFrame([(t, float(v), svc) for t, v, svc in rows], kind).withColumn("MetricName", F.lit("m"))


def test_windows_equal_batch_and_late_points_are_kept(spark, tmp_path):
    request = Series("gauge", "m", 0, q.END, ["count", "sum", "min", "max", "avg", "p50"], ["service-name"], "1m", None, limits=q.ALL)
    files = [[(t, t % 7, f"s{t % 2}") for t in range(0, 200)], [(5, 1, "s0"), *((t, t % 5, f"s{t % 2}") for t in range(150, 400))], [(t, 1, "s0") for t in range(400, 620)]]
    for rows in files:
        df = points(spark, rows)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        windows.window_stream(stream, str(tmp_path / "out"), str(tmp_path / "check"), request, delay_seconds=60).trigger(availableNow=True).start().awaitTermination(120)
    late = windows.late_points(spark, str(tmp_path / "out")).collect()
    assert [(r.time_unix, r.Value) for r in late] == [(5, 1.0)]
    timely = points(spark, [r for rows in files for r in rows if r != (5, 1, "s0")])
    want = {(r.bucket_start_nanos, r.service_name): r for r in series.metric_series(timely, request, approximate=False).collect()}
    got = {(r.bucket_start_nanos, r.service_name): r for r in windows.published(spark, str(tmp_path / "out")).collect()}
    # The watermark stands at 619 - 60 seconds: minutes 0 to 8 are out, each once.
    assert set(got) == {k for k in want if k[0] + 60 * 10**9 <= 559 * 10**9} and len(got) == windows.published(spark, str(tmp_path / "out")).count()
    assert all(tuple(got[k])[3:8] == tuple(want[k])[2:7] for k in got)
    still = windows.open_windows(spark, str(tmp_path / "out"), request, 60).collect()
    assert {(r.bucket_start_nanos, r.service_name) for r in still} == set(want) - set(got) and sum(r["count"] for r in still) + sum(r["count"] for r in got.values()) == timely.count()


def test_a_batch_that_runs_again_writes_the_same(spark, tmp_path):
    request = Series("sum", "m", 0, q.END, ["count", "sum"], ["service-name"], "1m", None, limits=q.ALL)
    first, second = points(spark, [(t, 1, "a") for t in range(100)]), points(spark, [(t, 1, "a") for t in range(100, 300)])
    for number, df in ((0, first), (1, second), (1, second)):
        windows.write_windows(df, str(tmp_path), number, request, 0)
    rows = windows.published(spark, str(tmp_path)).collect()
    assert sorted((r.bucket_start_nanos // 10**9, r["count"], r["sum"]) for r in rows) == [(0, 60, 60.0), (60, 60, 60.0), (120, 60, 60.0), (180, 60, 60.0)]


def span(n):
    return {"traceId": "t", "spanId": f"s{n}", "name": "op", "startTimeUnixNano": "1700000000000000001", "endTimeUnixNano": "1700000000000000009", "attributes": []}


def body(*spans_):
    return json.dumps({"resourceSpans": [{"resource": {"attributes": []}, "scopeSpans": [{"scope": {}, "spans": list(spans_)}]}]})


def test_lines_that_are_no_requests_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    bad = ['{"resourceSpans": [', "no json", '{"resourceSpans": 5}', '{"resourceLogs": []}']
    lines = [body(span(1)), bad[0], "", body(span(2), span(3)), *bad[1:]]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines) + "\n")
    out = str(tmp_path / "out")
    for _ in range(2):
        stream = otlp.lines(spark, str(tmp_path / "in"), stream=True)
        sinks.request_stream(stream, "spans", out, str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(120)
    rejected = spark.read.parquet(f"{out}/rejected/requests_spans").select("line", "reason").collect()
    assert sorted(map(tuple, rejected)) == sorted([*((x, "malformed") for x in bad[:3]), (bad[3], "no_request")])
    assert sorted(r.SpanId for r in commits.read_table(spark, out, "otel_traces").collect()) == ["s1", "s2", "s3"]
    # Every line that is not blank is a request or a reject.
    parsed = otlp.requests(otlp.lines(spark, str(tmp_path / "in")), "spans")
    assert parsed.count() == 6 and otlp.rejects(parsed).count() == 4 and otlp.span_records(parsed).count() == 3


def test_batches_without_marker_are_invisible(spark, tmp_path):
    parsed = lambda signal, text: otlp.RECORDS_OF[signal](otlp.requests(spark.createDataFrame([(text,)], "line string"), signal))
    fixed = lambda df: spark.createDataFrame(df.collect(), df.schema)  # noqa: E731  parsed once
    records = lambda *n: fixed(parsed("spans", body(*map(span, n))))
    metric = {"resourceMetrics": [{"resource": {}, "scopeMetrics": [{"scope": {}, "metrics": [{"name": "g", "gauge": {"dataPoints": [{"timeUnixNano": "1700000001000000000", "asDouble": 1.5}]}}, {"name": "c", "sum": {"aggregationTemporality": 2, "isMonotonic": True, "dataPoints": [{"startTimeUnixNano": "1", "timeUnixNano": "1700000001000000000", "asInt": 7}]}}, {"name": "h", "histogram": {"aggregationTemporality": 1, "dataPoints": [{"timeUnixNano": "1700000001000000000", "count": 3, "sum": 6.0, "bucketCounts": [1, 2], "explicitBounds": [10.0], "min": 1, "max": 3}]}}]}]}]}
    log = {"resourceLogs": [{"resource": {}, "scopeLogs": [{"scope": {}, "logRecords": [{"timeUnixNano": "5", "body": {"stringValue": "x"}}]}]}]}
    points_, logs = fixed(parsed("metrics", json.dumps(metric))), fixed(parsed("logs", json.dumps(log)))
    path = str(tmp_path)
    assert commits.read_table(spark, path, "otel_traces").count() == 0
    for number in ("0", "1"):  # the second batch is killed before its marker
        sinks.write_spans(records(1, 2) if number == "0" else records(2, 3), path, number)
        sinks.write_logs(logs, path, number)
        sinks.write_metrics(points_, path, number)
        for stream in ("spans", "logs", "metrics") if number == "0" else ():
            commits.commit(spark, path, stream, number)
    tables = {t: commits.read_table(spark, path, t) for t in s.TABLES}
    assert {t: df.count() for t, df in tables.items()} == {"otel_traces": 2, "otel_logs": 1, "otel_metrics_gauge": 1, "otel_metrics_sum": 1, "otel_metrics_histogram": 1}
    for t, df in tables.items():
        assert s.conform(df.drop("event_date"), s.TABLES[t]).columns
    for stream in ("spans", "logs", "metrics"):
        commits.commit(spark, path, stream, "1")
    # A record that was sent twice is one record to readers who ask for that; of spans by their ids.
    assert commits.read_table(spark, path, "otel_traces").count() == 4
    assert sorted(r.SpanId for r in commits.read_table(spark, path, "otel_traces", distinct=True).collect()) == ["s1", "s2", "s3"]
    assert all(commits.read_table(spark, path, t, distinct=True).count() == 1 for t in s.TABLES if t != "otel_traces")


def test_nested_values_come_out_as_json(spark):
    deep = {"stringValue": 'say "x"'}
    for i in range(5):
        deep = {"arrayValue": {"values": [deep, {"intValue": str(i)}]}} if i % 2 else {"kvlistValue": {"values": [{"key": f"k{i}", "value": deep}, {"key": "d", "value": {"doubleValue": 1e20}}]}}
    values = {"deep": deep, "empty": {"arrayValue": {}}, "none": {}, "map": {"kvlistValue": {"values": []}}, "num": {"doubleValue": 1.0}, "big": {"doubleValue": 1e21}, "int": {"intValue": 9007199254740993}, "raw": {"arrayValue": {"values": [{"bytesValue": "aGk="}, {}, {"boolValue": False}]}}}
    line = json.dumps({"resourceSpans": [{"scopeSpans": [{"spans": [{**span(1), "attributes": [{"key": k, "value": v} for k, v in values.items()]}]}]}]})
    rows = ingest.spans(otlp.span_records(otlp.requests(spark.createDataFrame([(line,)], "line string"), "spans")))
    got = rows.first().SpanAttributes

    def plain(v):
        if "arrayValue" in v:
            return [plain(x) for x in v["arrayValue"].get("values", [])]
        if "kvlistValue" in v:
            return {e["key"]: plain(e["value"]) for e in v["kvlistValue"]["values"]}
        return int(v["intValue"]) if "intValue" in v else next(iter(v.values()), None)

    assert json.loads(got["deep"]) == plain(deep) and '"d":100000000000000000000' in got["deep"]
    assert {k: got[k] for k in ("empty", "none", "map", "num", "big", "int", "raw")} == {"empty": "[]", "none": "", "map": "{}", "num": "1", "big": "1e+21", "int": "9007199254740993", "raw": '["aGk=",null,false]'}
