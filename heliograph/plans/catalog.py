"""Telemetry queries over the given tables, by operator, with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import cumulative, ingest, reports, rollup, scan, series, typed
from ..sources import adapters as a, schema
from . import results
from .requests import MAX_INT64, Limits, Series, TopValues

#: All of time: every query reads its whole tables.
START, END = 0, MAX_INT64
ALL = Limits(max_window_nanos=MAX_INT64)

E = """e AS (SELECT *, epoch_us(ts) * 1000 AS tns, 'svc-' || (user_id % 5) AS svc, (props->>'$.k') AS k, lpad(user_id::VARCHAR, 32, '0') AS trace, lpad(event_id::VARCHAR, 16, '0') AS span,
 CASE WHEN user_id % 2 = 0 THEN 'prod' ELSE 'test' END AS env, CASE WHEN event_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method, CASE WHEN event_id % 3 = 0 THEN 'Server' ELSE 'Internal' END AS kind,
 CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Ok' END AS status, round(value * 1e6)::BIGINT AS duration, epoch_us(ts) // 1000000 AS sec FROM events)"""
GRID = """h AS (SELECT event_type, svc, sec - sec % 86400 AS d, ((sec % 86400) // 3600)::INT + 1 AS hour, count(*) AS c, sum(value) AS v,
 count(*) FILTER (value <= 25) AS b0, count(*) FILTER (value > 25 AND value <= 50) AS b1, count(*) FILTER (value > 50 AND value <= 100) AS b2, count(*) FILTER (value > 100 AND value <= 200) AS b3, count(*) FILTER (value > 200) AS b4 FROM e GROUP BY ALL),
g AS (SELECT k.event_type, k.svc, k.d, k.hour, coalesce(c, 0) AS c, coalesce(v, 0) AS v, coalesce(b0, 0) AS b0, coalesce(b1, 0) AS b1, coalesce(b2, 0) AS b2, coalesce(b3, 0) AS b3, coalesce(b4, 0) AS b4
 FROM (SELECT DISTINCT event_type, svc, d, unnest(range(1, 25)) AS hour FROM h) k LEFT JOIN h USING (event_type, svc, d, hour))"""


def r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in cols})


def _top(fields: dict[str, str], source: str, signal: str, limit: int) -> str:
    one = " UNION ALL ".join(f"SELECT '{f}' AS field, left({c}, 128) AS value FROM {source}" for f, c in fields.items())
    return f"SELECT '{signal}' AS signal, field, value, count FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY count DESC, value) AS r FROM (SELECT field, value, count(*) AS count FROM ({one}) WHERE value != '' GROUP BY 1, 2)) WHERE r <= {limit}"


SPAN_FIELDS = {"service-name": "svc", "span-name": "event_type", "span-kind": "kind", "status-code": "status", "scope-name": "''", "trace-id": "trace", "deployment-environment": "env", "http-request-method": "method"}


def _logs(spark, d):
    return ingest.logs(a.log_records(spark, d))


def d_1a(spark, d):
    return series.top_values(a.spans(spark, d), TopValues("spans", list(SPAN_FIELDS), START, END, 5, limits=ALL))


def d_1b(spark, d):
    return series.top_values(_logs(spark, d), TopValues("logs", ["service-name", "severity-text", "event-name", "scope-name", "trace-id"], START, END, 5, limits=ALL))


def d_1s(spark, d):
    """Trace and span ids, service and name by sketch: the rows that exact counts give."""
    rows = a.order_spans(spark, d).withColumn("ServiceName", F.concat(F.lit("s"), F.left("TraceId", F.lit(2))))
    return series.top_values_sketched(rows, TopValues("spans", ["trace-id", "service-name", "span-name"], START, END, 5, limits=ALL))


def a_8(spark, d):
    u = scan.metric_union(a.gauges(spark, d), a.sums(spark, d, True), a.histograms(spark, d, True))
    return u.groupBy("MetricName", "ServiceName").agg(F.count("*").alias("n"))


def d_1c(spark, d):
    u = scan.metric_union(a.gauges(spark, d), a.sums(spark, d, True), a.histograms(spark, d, True))
    return series.top_values(u, TopValues("metrics", ["service-name", "metric-name", "metric-unit", "scope-name", "deployment-environment"], START, END, 5, limits=ALL))


def a_7(spark, d):
    return scan.in_window(a.spans(spark, d), START, END).select("TraceId", "SpanId", "timestamp_nanos", "SpanName", "ServiceName", "Duration")


def d_2(spark, d):
    q = Series("gauge", "event.value", START, END, ["count", "sum", "min", "max", "avg", "p50", "p95", "p99"], ["service-name"], "1h", None, limits=ALL)
    return r6(series.metric_series(a.gauges(spark, d), q, approximate=False), "sum", "avg", "p50", "p95", "p99")


def d_3(spark, d):
    q = Series("sum", "events.view", START, END, ["count", "sum", "max", "avg"], ["service-name"], limit=None, limits=ALL)
    return r6(series.metric_series(a.sums(spark, d, False), q), "sum", "avg")


def d_4(spark, d):
    q = Series("histogram", "latency.view", START, END, ["count", "sum", "avg"], ["service-name"], "1h", None, limits=ALL)
    both = a.histograms(spark, d, False).unionByName(a.histograms(spark, d, True))
    return r6(series.metric_series(both, q), "sum", "avg").withColumn("count", F.col("count").cast("long"))


def d_5(spark, d):
    """No row for a metric without points."""
    return series.metric_series(a.gauges(spark, d), Series("gauge", "no.such.metric", START, END, ["count", "sum"], limits=ALL))


def d_6(spark, d):
    q = Series("cumulative-counter", "events.click", START, END, ["increase", "rate"], ["service-name"], "1h", None, temporality="cumulative", monotonic=True, limits=ALL)
    return r6(cumulative.counter_series(a.all_sums(spark, d), q), "increase", "rate")


def d_7(spark, d):
    q = Series("cumulative-histogram", "latency.view", START, END, ["count", "sum", "avg", "p50", "p95"], ["service-name"], limit=None, temporality="cumulative", limits=ALL)
    out = cumulative.histogram_series(a.histograms(spark, d, True), q)
    flat = out.select(
        "service_name", F.col("count").cast("long").alias("count"), "sum", "avg", F.col("p50.estimate").alias("p50"), F.col("p50.max_error").alias("p50_error"), F.col("p50.in_bucket").cast("long").alias("p50_in_bucket"),
        F.col("p95.estimate").alias("p95"), "interval_count", "reset_count", "observed_duration_nanos",
    )
    return r6(flat, "sum", "avg", "p50", "p50_error", "p95")


def d_6s(spark, d):
    """The counter of d_6 in slices of seven hours, which hand their last snapshot on."""
    q = Series("cumulative-counter", "events.click", START, END, ["increase", "rate"], ["service-name"], "1h", None, temporality="cumulative", monotonic=True, limits=ALL)
    return r6(cumulative.counter_series(a.all_sums(spark, d), q, slice_nanos=7 * 3600 * 10**9), "increase", "rate")


def d_2r(spark, d):
    """Minutes rolled up to hours and then to days, with sketched quantiles that lie within the sketch's bound."""
    minutes = rollup.partials(a.gauges(spark, d), 60 * 10**9, ["service-name"])
    days = rollup.merged(rollup.merged(minutes, 3600 * 10**9), 86_400 * 10**9)
    out = rollup.finished(days, ["count", "sum", "min", "max", "avg", "p50", "p95"])
    # Twice the bound: it holds with a confidence of 99 %, and there are many days.
    off, v = 2 * rollup.rank_error(), F.col("Value").cast("double")
    day = rollup.start_of(F.col("time_unix") * 10**9, 86_400 * 10**9)
    exact = a.gauges(spark, d).groupBy(day.alias("bucket_start_nanos"), F.col("ServiceName").alias("service_name")).agg(*[F.percentile(v, F.lit(min(1.0, max(0.0, q + s * off)))).alias(f"{n}{'lh'[s > 0]}") for n, q in (("p50", 0.5), ("p95", 0.95)) for s in (-1, 1)])
    both = out.join(exact, ["bucket_start_nanos", "service_name"])
    # A sketch of few points gives one of them, the exact quantile lies between two.
    near = [((F.col(n) >= F.col(f"{n}l")) & (F.col(n) <= F.col(f"{n}h")) | (F.col("count") * off < 2)).alias(f"{n}_near") for n in ("p50", "p95")]
    return r6(both.select("bucket_start_nanos", "MetricName", "service_name", "count", "sum", "min", "max", "avg", *near), "sum", "avg")


def d_9c(spark, d):
    """Matches and coverage of one scan: every match with the counts of all rows."""
    rows, fields = _typed_spans(spark, d)
    found = typed.typed_matches(rows, typed.bound_field(fields, typed.typed_fields(spark, fields, "otel_traces").where("key = 'k'").first().schema_binding), "gte", 50, START, END, 50, ALL)
    return _with_coverage(spark, found)


def d_12c(spark, d):
    rows, fields = _typed_logs(spark, d)
    return _with_coverage(spark, typed.typed_matches(rows, fields[1], "starts-with", "n-pur", START, END, 50, ALL))


def _with_coverage(spark, found):
    matches, coverage = found.answer()  # at most 50 rows
    return spark.createDataFrame(matches, found.rows.schema).select("*", *[F.lit(n).cast("long").alias(c) for c, n in coverage.items()])


def d_14(spark, d):
    """Bindings of all typed columns of points, as queries accept them."""
    return _discovered(spark, d, "gauge").unionByName(_discovered(spark, d, "sum")).unionByName(_discovered(spark, d, "histogram"))


def _discovered(spark, d, kind):
    """Each binding with the number of rows that its field is valid in, asked by that binding alone."""
    rows, fields = _typed_points(kind)(spark, d)
    found = typed.typed_fields(spark, fields, f"otel_metrics_{kind}")
    out = None
    for r in found.collect():
        valid = typed.typed_coverage(rows, typed.bound_field(fields, r.schema_binding), START, END, ALL).select("valid")
        one = valid.select(F.lit(r.metric_kind).alias("metric_kind"), F.lit(r.key).alias("key"), F.lit(r.schema_binding.field_id).alias("field_id"), F.lit(r.schema_binding.manifest_version).cast("long").alias("manifest_version"), F.lit(",".join(r.operators)).alias("operators"), "valid")
        out = one if out is None else out.unionByName(one)
    return out


def e_11(spark, d):
    """The series of d_4 through the declared shape of its result."""
    q = Series("histogram", "latency.view", START, END, ["count", "sum", "avg"], ["service-name"], "1h", None, limits=ALL)
    both = a.histograms(spark, d, False).unionByName(a.histograms(spark, d, True))
    return r6(results.shaped(series.metric_series(both, q), results.series_shape(q), q.max_text_length), "sum", "avg").withColumn("count", F.col("count").cast("long"))


def d_24t(spark, d):
    """The difference of d_24b by digests of days and ranges of spans."""
    written = a.spans(spark, d)
    read = written.where("event_id % 50 != 0").withColumn("StatusCode", F.when(F.col("event_id") % 75 == 1, "Lost").otherwise(F.col("StatusCode")))
    return reports.difference_by_tree(written, read, "timestamp_nanos DIV 86400000000000", "xxhash64(SpanId)").select("side", "SpanId", "StatusCode")


def d_23(spark, d):
    return r6(reports.dashboard(a.spans(spark, d), approximate=False), "p95_ms")


def d_24(spark, d):
    return reports.digest(a.spans(spark, d).drop("k"), "otel_traces").unionByName(reports.digest(_logs(spark, d), "otel_logs"))


def d_24b(spark, d):
    """Rows that one side lacks: the reader misses some spans and has others with another status."""
    written = a.spans(spark, d)
    read = written.where("event_id % 50 != 0").withColumn("StatusCode", F.when(F.col("event_id") % 75 == 1, "Lost").otherwise(F.col("StatusCode")))
    return reports.difference(written, read).select("side", "SpanId", "StatusCode")


def d_25(spark, d):
    return reports.correlate(_logs(spark, d), a.spans(spark, d)).groupBy("span_service", "SpanName", "SeverityText").agg(F.count("*").alias("n"))


def _typed_spans(spark, d):
    return a.typed_rows(a.spans(spark, d), "otel_traces", "traces", "span", "SpanAttributes", "SpanName")


def _typed_logs(spark, d):
    rows = _logs(spark, d).withColumns({"event_id": F.col("SpanId").cast("long"), "k": F.try_element_at("LogAttributes", F.lit("k"))})
    return a.typed_rows(rows, "otel_logs", "logs", "log", "LogAttributes", "EventName")


def _typed_points(kind):
    """Points of the kind: gauges with the event's k, running sums and hourly histograms with their hour as k."""

    def rows(spark, d):
        base = {"gauge": a.gauges, "sum": lambda s, p: a.sums(s, p, True), "histogram": lambda s, p: a.histograms(s, p, False)}[kind](spark, d)
        if kind != "gauge":
            base = base.withColumns({"event_id": F.col("hour"), "k": F.col("hour").cast("string")})
        base = base.withColumn("Attributes", F.create_map(F.lit("k"), F.col("k")))
        return a.typed_rows(base, f"otel_metrics_{kind}", "metrics", "point", "Attributes", "event_type")

    return rows


def d_8(spark, d):
    rows, fields = _typed_spans(spark, d)
    return typed.typed_values(rows, fields, START, END, None, ALL)


def d_9(spark, d):
    rows, fields = _typed_spans(spark, d)
    return typed.typed_filtered(rows, fields[0], "gte", 50, START, END, 50, ALL)


def d_10(spark, d):
    rows, fields = _typed_spans(spark, d)
    return typed.typed_coverage(rows, typed.bound_field(fields, typed.binding_of(fields[0])), START, END, ALL)


def d_11(spark, d):
    rows, fields = _typed_spans(spark, d)
    return r6(typed.typed_int64_aggregates(rows, fields[0], START, END, gte=10, lt=90, by_service=True, limits=ALL), "avg")


def d_12(spark, d):
    rows, fields = _typed_logs(spark, d)
    return typed.typed_filtered(rows, fields[1], "starts-with", "n-pur", START, END, 50, ALL)


def d_13(spark, d):
    rows, fields = _typed_logs(spark, d)
    return typed.typed_coverage(rows, fields[1], START, END, ALL)


def _point_queries(kind):
    def coverage(spark, d):
        rows, fields = _typed_points(kind)(spark, d)
        return typed.typed_coverage(rows, fields[0], START, END, ALL)

    def filtered(spark, d):
        rows, fields = _typed_points(kind)(spark, d)
        out = typed.typed_filtered(rows, fields[0], "lt", 20, START, END, None, ALL)
        last = "Count" if kind == "histogram" else "Value"
        return out.select("time_unix", "MetricName", "ServiceName", F.col(last).cast("double").alias("point"), "typed_value")

    return coverage, filtered


def b_1(spark, d):
    rows = ingest.spans(a.span_records(spark, d))
    schema.conform(rows, schema.SPANS)
    return rows.select("timestamp_nanos", "TraceId", "SpanId", "ParentSpanId", "TraceState", "SpanName", "SpanKind", "ServiceName", "Duration", "StatusCode", F.col("SpanAttributes")["k"].alias("k"), F.col("SpanAttributes")["type"].alias("type"), F.col("SpanAttributes")["odd"].alias("odd"),
        F.get("events_timestamp", F.lit(0)).alias("event_at"), F.get("events_name", F.lit(0)).alias("event_name"), F.get("events_attributes", F.lit(0))["k"].alias("event_k"), F.get("links_trace_id", F.lit(0)).alias("link_trace"),
        F.get("links_span_id", F.lit(0)).alias("link_span"), F.get("links_trace_state", F.lit(0)).alias("link_state"), F.get("links_attributes", F.lit(0))["why"].alias("link_why"), "EventsJSON", "LinksJSON")


def b_2(spark, d):
    return _logs(spark, d).select("timestamp_nanos", "TraceId", "SpanId", F.col("TraceFlags").cast("int").alias("TraceFlags"), "SeverityText", F.col("SeverityNumber").cast("int").alias("SeverityNumber"), "ServiceName", "Body", "EventName", F.col("LogAttributes")["user.id"].alias("user_id"))


def b_23(spark, d):
    """Every 40th span starts before time."""
    records = a.span_records(spark, d)
    number = F.col("span_context.span_id").cast("long")
    records = records.withColumn("start_time_unix_nano", F.when(number % 40 == 0, -F.col("start_time_unix_nano")).otherwise(F.col("start_time_unix_nano")))
    good, bad = ingest.split_violations(ingest.spans(records))
    return good.agg(F.count("*").alias("n")).withColumn("side", F.lit("good")).unionByName(bad.agg(F.count("*").alias("n")).withColumn("side", F.lit("bad")))


def b_25(spark, d):
    return ingest.trace_lookup(a.order_spans(spark, d))


def a_14(spark, d):
    rows = a.order_spans(spark, d)
    return scan.trace_rows(rows, ingest.trace_lookup(rows), "1").select("TraceId", "SpanId", "ParentSpanId", "timestamp_nanos")


def c_3(spark, d):
    """Declarations from event types: each type names a key, in both spans and logs."""
    e = spark.read.parquet(f"{d}/events.parquet").select("event_type").distinct()
    decl = e.select(F.lit("traces").alias("signal"), F.lit("otel_traces").alias("table"), F.lit("span").alias("location"), F.concat(F.lit("event."), "event_type").alias("key"), F.when(F.col("event_type") == "click", "int64").otherwise("string").alias("type"), F.lit("manifest").alias("provenance"))
    twice = decl.unionByName(decl.withColumns({"provenance": F.lit("source"), "type": F.when(F.col("key") == "event.view", "boolean").otherwise(F.col("type"))}))
    good, bad = typed.merge_declarations(typed.declarations(twice)[0])
    named = typed.physical_names(good).select("key", "type", F.array_join("provenance", ",").alias("provenance"), "attribute_id", "value_column")
    return named.unionByName(bad.select("key", F.lit("conflict").alias("type"), F.array_join("provenance", ",").alias("provenance"), F.lit("").alias("attribute_id"), F.lit("").alias("value_column")))


def c_7(spark, d):
    rows, (k, note) = _typed_spans(spark, d)
    return rows.groupBy("SpanName").agg(*[F.count_if(F.col(f.status_column) == i).alias(f"{f.key}_{i}") for f in (k, note) for i in range(5)], F.sum(k.value_column).alias("k_sum"))


def c_5(spark, d):
    rows, fields = _typed_spans(spark, d)
    have = rows.drop(fields[1].status_column)
    state = typed.reconcile_columns(have, fields)
    added = typed.add_columns(have, fields)
    return state.crossJoin(F.broadcast(added.agg(F.count_if(F.col(fields[1].status_column) == 0).alias("historical")))).select("state", "expected", "historical")


def _point(name, own):
    def query(spark, d):
        """A gauge, a sum and a histogram for each event, of two points each; a point has what its kind has."""
        e = a.spread(a.events(spark, d))
        bucket = ", ".join(f"cast(if({' + '.join(f'int(value > {b}D)' for b in a.BOUNDS)} = {i}, 1, 0) AS decimal(20,0))" for i in range(5))
        attrs, resource, scope = (t.simpleString() for t in (schema.ATTRS, schema.RESOURCE, schema.SCOPE))
        point = lambda value, count, buckets: f"struct(tns AS start_time_unix_nano, tns + 1500000000 AS time_unix_nano, cast(NULL AS {attrs}) AS attributes, cast({value} AS double) AS value, cast({count} AS decimal(20,0)) AS count, cast({value if buckets is None else 'value'} AS double) AS sum, cast({buckets or 'NULL'} AS array<decimal(20,0)>) AS bucket_counts, cast(NULL AS double) AS min, cast(value AS double) AS max)"
        numbers, counts = point("value", "NULL", None), point("NULL", "1", f"array({bucket})")
        metric = lambda kind, p: f"struct(concat('m.', event_type) AS name, cast(NULL AS string) AS description, 'ms' AS unit, '{kind}' AS type, if(event_id % 2 = 0, 'delta', 'cumulative') AS temporality, true AS monotonic, array({', '.join(f'{b}D' for b in a.BOUNDS)}) AS explicit_bounds, array({p}, {p}) AS data_points)"
        metrics = f"array({metric('gauge', numbers)}, {metric('sum', numbers)}, {metric('histogram', counts)})"
        records = e.selectExpr(f"cast(NULL AS {resource}) AS resource", f"array(struct(cast(NULL AS {scope}) AS scope, {metrics} AS metrics)) AS scope_metrics")
        return own(records)

    query.__name__ = name
    return query


b_5 = _point("b_5", lambda r: r6(ingest.gauges(ingest.metric_points(r, "gauge")).groupBy("MetricName", "start_time_unix").agg(F.count("*").alias("n"), F.sum("Value").alias("total"), F.max("time_unix").alias("last")), "total"))
b_6 = _point("b_6", lambda r: r6(ingest.sums(ingest.metric_points(r, "sum")).groupBy("MetricName", "AggregationTemporality", "IsMonotonic").agg(F.count("*").alias("n"), F.sum("Value").alias("total")), "total"))
b_7 = _point("b_7", lambda r: r6(ingest.histograms(ingest.metric_points(r, "histogram")).groupBy("MetricName").agg(F.count("*").alias("n"), F.sum("Sum").alias("total"), F.max("Min").alias("least"), F.sum(F.get("BucketCounts", F.lit(0))).cast("long").alias("b0")), "total"))

QUERIES = {f.__name__: f for f in (a_7, a_8, a_14, b_1, b_2, b_5, b_6, b_7, b_23, b_25, c_3, c_5, c_7, d_1a, d_1b, d_1c, d_1s, d_2, d_2r, d_3, d_4, d_5, d_6, d_6s, d_7, d_8, d_9, d_9c, d_10, d_11, d_12, d_12c, d_13, d_14, d_23, d_24, d_24b, d_24t, d_25, e_11)}
for _n, _k in ((17, "gauge"), (18, "sum"), (19, "histogram")):
    QUERIES[f"d_{_n}"], QUERIES[f"d_{_n + 3}"] = _point_queries(_k)

STATUS = "CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'error' THEN 4 ELSE 3 END"
NOTE_STATUS = "CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END"
COVER = "SELECT count(*) AS total, count(*) FILTER (st = 3) AS valid, count(*) FILTER (st = 2) AS present_empty, count(*) FILTER (st = 1) AS absent, count(*) FILTER (st = 4) AS invalid, count(*) FILTER (st = 0 AND held) AS fallback, count(*) FILTER (st = 0 AND NOT held) AS unavailable, 0::BIGINT AS unknown_status FROM"
ORDER_SPANS = "s AS (SELECT epoch_us(o_orderdate::TIMESTAMP) // 1000000 AS t, o_orderkey::VARCHAR AS TraceId, o_orderkey::VARCHAR AS SpanId, '' AS ParentSpanId FROM orders UNION ALL SELECT epoch_us(l_shipdate::TIMESTAMP) // 1000000, l_orderkey::VARCHAR, (l_orderkey * 10 + l_linenumber)::VARCHAR, l_orderkey::VARCHAR FROM lineitem)"
UNION = f"u AS (SELECT 'event.value' AS name, svc, sec AS t, env FROM e UNION ALL SELECT 'events.' || event_type, svc, d + hour * 3600, '' FROM g UNION ALL SELECT 'latency.' || event_type, svc, d + hour * 3600, '' FROM g)"

ORACLES = {
    "a_7": f"WITH {E} SELECT trace AS TraceId, span AS SpanId, tns AS timestamp_nanos, event_type AS SpanName, svc AS ServiceName, duration AS Duration FROM e",
    "a_8": f"WITH {E}, {GRID}, {UNION} SELECT name AS MetricName, svc AS ServiceName, count(*) AS n FROM u GROUP BY 1, 2",
    "a_14": f"WITH {ORDER_SPANS} SELECT TraceId, SpanId, ParentSpanId, t * 1000000000 AS timestamp_nanos FROM s WHERE TraceId = '1'",
    "b_1": f"WITH {E} SELECT tns AS timestamp_nanos, trace AS TraceId, span AS SpanId, '' AS ParentSpanId, 'a=1,b=' || event_type AS TraceState, event_type AS SpanName, kind AS SpanKind, CASE WHEN user_id % 7 = 0 THEN '' ELSE svc END AS ServiceName, greatest(0, duration - 5000000) AS Duration, CASE WHEN event_type = 'error' THEN 'Error' ELSE 'Unset' END AS StatusCode, k, upper(event_type) AS type, CASE WHEN event_id % 2 = 1 THEN 'true' ELSE 'false' END AS odd, CASE WHEN event_type = 'purchase' THEN tns + 1 END AS event_at, CASE WHEN event_type = 'purchase' THEN 'paid' END AS event_name, CASE WHEN event_type = 'purchase' THEN k END AS event_k, CASE WHEN event_type = 'signup' THEN 'root' END AS link_trace, CASE WHEN event_type = 'signup' THEN event_id::VARCHAR END AS link_span, CASE WHEN event_type = 'signup' THEN 's=1' END AS link_state, CASE WHEN event_type = 'signup' THEN 'first' END AS link_why, CASE WHEN event_type = 'purchase' THEN '[{{\"timestamp\":' || (tns + 1) || ',\"name\":\"paid\",\"attributes\":{{\"k\":\"' || k || '\"}}}}]' ELSE '[]' END AS EventsJSON, CASE WHEN event_type = 'signup' THEN '[{{\"trace_id\":\"root\",\"span_id\":\"' || event_id || '\",\"attributes\":{{\"why\":\"first\"}}}}]' ELSE '[]' END AS LinksJSON FROM e",
    "b_2": f"WITH {E} SELECT tns AS timestamp_nanos, trace AS TraceId, span AS SpanId, 1 AS TraceFlags, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS SeverityText, CASE WHEN event_type = 'error' THEN 17 ELSE 9 END AS SeverityNumber, svc AS ServiceName, props AS Body, event_type AS EventName, user_id::VARCHAR AS user_id FROM e",
    "b_5": f"WITH {E} SELECT 'm.' || event_type AS MetricName, sec AS start_time_unix, 2 * count(*) AS n, round(2 * sum(value), 6) AS total, max((tns + 1500000000) // 1000000000) AS last FROM e GROUP BY 1, 2",
    "b_6": f"WITH {E} SELECT 'm.' || event_type AS MetricName, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS AggregationTemporality, true AS IsMonotonic, 2 * count(*) AS n, round(2 * sum(value), 6) AS total FROM e GROUP BY 1, 2",
    "b_7": f"WITH {E} SELECT 'm.' || event_type AS MetricName, 2 * count(*) AS n, round(2 * sum(value), 6) AS total, 0.0::DOUBLE AS least, 2 * count(*) FILTER (value <= 25) AS b0 FROM e GROUP BY 1",
    "b_23": "SELECT count(*) AS n, CASE WHEN event_id % 40 = 0 THEN 'bad' ELSE 'good' END AS side FROM events GROUP BY 2",
    "b_25": f"WITH {ORDER_SPANS} SELECT TraceId, min(t) AS start_unix, max(t) AS end_unix FROM s GROUP BY 1",
    "c_3": """WITH k AS (SELECT DISTINCT 'event.' || event_type AS key, event_type FROM events), i AS (SELECT *, sha256('{"signal":"traces","table":"otel_traces","location":"span","key":"' || key || '"}') AS h FROM k)
 SELECT key, CASE event_type WHEN 'click' THEN 'int64' WHEN 'view' THEN 'conflict' ELSE 'string' END AS type, 'manifest,source' AS provenance, CASE WHEN event_type = 'view' THEN '' ELSE 'attribute_' || h[:20] END AS attribute_id, CASE WHEN event_type = 'view' THEN '' ELSE 'av_traces_span_event_' || event_type || '_' || h[:16] END AS value_column FROM i""",
    "c_5": "SELECT s.state, s.expected, (SELECT count(*) FROM events) AS historical FROM (VALUES ('ok', 'bigint'), ('ok', 'smallint'), ('ok', 'string'), ('missing', 'smallint')) s(state, expected)",
    "c_7": f"WITH {E}, t AS (SELECT *, {STATUS} AS st, {NOTE_STATUS} AS ns FROM e) SELECT event_type AS SpanName, " + ", ".join(f"count(*) FILTER ({c} = {i}) AS {n}_{i}" for n, c in (("k", "st"), ("note", "ns")) for i in range(5)) + ", sum(CASE WHEN st = 3 THEN k::BIGINT ELSE 0 END)::BIGINT AS k_sum FROM t GROUP BY 1",
    "d_1a": f"WITH {E} " + _top(SPAN_FIELDS, "e", "spans", 5),
    "d_1b": f"WITH {E} " + _top({"service-name": "svc", "severity-text": "CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END", "event-name": "event_type", "scope-name": "''", "trace-id": "trace"}, "e", "logs", 5),
    "d_1c": f"WITH {E}, {GRID}, {UNION} " + _top({"service-name": "svc", "metric-name": "name", "metric-unit": "'ms'", "scope-name": "CASE WHEN name != '' THEN 'events' END", "deployment-environment": "env"}, "u", "metrics", 5),
    "d_2": f"WITH {E} SELECT (sec - sec % 3600) * 1000000000 AS bucket_start_nanos, svc AS service_name, count(*) AS count, round(sum(value), 6) AS sum, min(value) AS min, max(value) AS max, round(avg(value), 6) AS avg, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM e GROUP BY 1, 2",
    "d_3": f"WITH {E}, {GRID} SELECT svc AS service_name, count(*) AS count, round(sum(c)::DOUBLE, 6) AS sum, max(c)::DOUBLE AS max, round(avg(c), 6) AS avg FROM g WHERE event_type = 'view' GROUP BY 1",
    "d_4": f"WITH {E}, {GRID} SELECT (d + hour * 3600) * 1000000000 AS bucket_start_nanos, svc AS service_name, sum(c)::BIGINT AS count, round(sum(v), 6) AS sum, CASE WHEN sum(c) = 0 THEN 0.0 ELSE round(sum(v) / sum(c), 6) END AS avg FROM g WHERE event_type = 'view' GROUP BY 1, 2",
    "d_5": "SELECT 0::BIGINT AS count, 0.0::DOUBLE AS sum WHERE false",
    "d_6": f"""WITH {E}, {GRID}, r AS (SELECT svc, d AS s, d + hour * 3600 AS t, sum(c) OVER (PARTITION BY svc, d ORDER BY hour) AS total FROM g WHERE event_type = 'click'), w AS (SELECT *, lag(t) OVER p AS pt, lag(s) OVER p AS ps, lag(total) OVER p AS pv FROM r WINDOW p AS (PARTITION BY svc ORDER BY t)),
 i AS (SELECT svc, t, CASE WHEN pt IS NULL OR s > ps THEN s ELSE pt END AS b, (pt IS NULL OR s > ps) AS reset, CASE WHEN pt IS NULL OR s > ps THEN total ELSE total - pv END AS v FROM w)
 SELECT ((t - 1) // 3600 * 3600) * 1000000000 AS bucket_start_nanos, svc AS service_name, round(sum(v)::DOUBLE, 6) AS increase, round(sum(v) / sum(t - b), 6) AS rate, count(*) AS interval_count, count(*) FILTER (reset) AS reset_count, (sum(t - b) * 1000000000)::BIGINT AS observed_duration_nanos FROM i WHERE t > b GROUP BY 1, 2""",
    "d_7": f"""WITH {E}, {GRID}, m AS (SELECT svc, sum(c) AS n, sum(v) AS total, sum(b0) AS b0, sum(b1) AS b1, sum(b2) AS b2, sum(b3) AS b3, sum(b4) AS b4, count(*) AS ic, count(DISTINCT d) AS rc FROM g WHERE event_type = 'view' GROUP BY 1),
 x AS (SELECT *, unnest([0.5, 0.95]) AS q FROM m), y AS (SELECT *, q * n AS rank, CASE WHEN b0 >= q * n THEN 0 WHEN b0 + b1 >= q * n THEN 1 WHEN b0 + b1 + b2 >= q * n THEN 2 WHEN b0 + b1 + b2 + b3 >= q * n THEN 3 ELSE 4 END AS pos FROM x),
 z AS (SELECT *, [b0, b1, b2, b3, b4][pos + 1] AS inb, [0, b0, b0 + b1, b0 + b1 + b2, b0 + b1 + b2 + b3][pos + 1] AS below, CASE WHEN pos BETWEEN 1 AND 3 THEN [25, 50, 100, 200][pos] END AS lo, CASE WHEN pos BETWEEN 1 AND 3 THEN [25, 50, 100, 200][pos + 1] END AS hi FROM y),
 f AS (SELECT *, CASE WHEN n > 0 THEN lo + (hi - lo) * (rank - below) / inb END AS est FROM z)
 SELECT svc AS service_name, any_value(n)::BIGINT AS count, round(any_value(total), 6) AS sum, round(any_value(total / nullif(n, 0)), 6) AS avg, round(max(est) FILTER (q = 0.5), 6)::DOUBLE AS p50, round(max(greatest(est - lo, hi - est)) FILTER (q = 0.5), 6)::DOUBLE AS p50_error, max(CASE WHEN n > 0 THEN inb END) FILTER (q = 0.5)::BIGINT AS p50_in_bucket, round(max(est) FILTER (q = 0.95), 6)::DOUBLE AS p95, any_value(ic) AS interval_count, any_value(rc) AS reset_count, (any_value(ic) * 3600 * 1000000000)::BIGINT AS observed_duration_nanos FROM f GROUP BY 1""",
    "d_8": f"""WITH {E}, t AS (SELECT *, {STATUS} AS st, {NOTE_STATUS} AS ns FROM e), v AS (SELECT 'k' AS attribute_key, 'span' AS location, CASE WHEN st = 3 THEN k WHEN st IN (0, 4) AND event_id % 2 = 0 THEN k END AS value, st AS typed_status FROM t UNION ALL SELECT 'note', 'span', CASE WHEN ns = 2 THEN '' WHEN ns = 3 THEN 'n-' || event_type END, ns FROM t)
 SELECT attribute_key, location, value, typed_status, CASE WHEN typed_status IN (2, 3) THEN 'typed' ELSE 'fallback' END AS source, count(*) AS count FROM v WHERE value IS NOT NULL GROUP BY ALL""",
    "d_9": f"WITH {E} SELECT trace AS TraceId, span AS SpanId, tns AS timestamp_nanos, event_type AS SpanName, svc AS ServiceName, duration AS Duration, status AS StatusCode, k::BIGINT AS typed_value FROM e WHERE {STATUS} = 3 AND k::BIGINT >= 50 ORDER BY tns DESC, trace, span LIMIT 50",
    "d_10": f"WITH {E} {COVER} (SELECT {STATUS} AS st, event_id % 2 = 0 AS held FROM e)",
    "d_11": f"WITH {E} SELECT svc AS service_name, count(*) AS count, min(k::BIGINT) AS min, max(k::BIGINT) AS max, round(avg(k::BIGINT), 6) AS avg FROM e WHERE {STATUS} = 3 AND k::BIGINT >= 10 AND k::BIGINT < 90 GROUP BY 1",
    "d_12": f"WITH {E} SELECT trace AS TraceId, span AS SpanId, tns AS timestamp_nanos, svc AS ServiceName, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS SeverityText, props AS Body, 'n-' || event_type AS typed_value FROM e WHERE event_type = 'purchase' ORDER BY tns DESC, trace, span LIMIT 50",
    "d_13": f"WITH {E} {COVER} (SELECT {NOTE_STATUS} AS st, false AS held FROM e)",
    "d_23": f"WITH {E} SELECT event_type AS SpanName, count(*) AS n, round(quantile_cont(duration / 1e6, 0.95), 6) AS p95_ms FROM e GROUP BY 1 ORDER BY n DESC, 1 LIMIT 8",
    "d_24": f"WITH {E}, r AS (SELECT 'otel_traces' AS name, concat_ws(chr(31), tns, trace, span, '', event_type, kind, svc, '', duration, status, 'http.request.method=' || method || ',k=' || coalesce(k, ''), 'deployment.environment.name=' || env, event_id) AS t FROM e UNION ALL SELECT 'otel_logs', concat_ws(chr(31), tns, trace, span, 1, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END, CASE WHEN event_type = 'error' THEN 17 ELSE 9 END, svc, props, '', 'service.name=' || svc, '', '', '', '', 'k=' || k || ',user.id=' || user_id, event_type) FROM e) SELECT name, count(*) AS rows, sum(('0x' || left(md5(t), 15))::BIGINT)::VARCHAR AS digest FROM r GROUP BY 1",
    "d_24b": f"WITH {E} SELECT 'written' AS side, span AS SpanId, status AS StatusCode FROM e WHERE event_id % 50 = 0 OR event_id % 75 = 1 UNION ALL SELECT 'read', span, 'Lost' FROM e WHERE event_id % 50 != 0 AND event_id % 75 = 1",
    "d_25": f"WITH {E} SELECT svc AS span_service, event_type AS SpanName, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS SeverityText, count(*) AS n FROM e GROUP BY ALL",
}
ORACLES["d_17"] = f"WITH {E} {COVER} (SELECT {STATUS} AS st, event_id % 2 = 0 AS held FROM e)"
ORACLES["d_20"] = f"WITH {E} SELECT sec AS time_unix, 'event.value' AS MetricName, svc AS ServiceName, value AS point, k::BIGINT AS typed_value FROM e WHERE {STATUS} = 3 AND k::BIGINT < 20"
for _n, _stem, _v in ((18, "events.", "sum(c) OVER (PARTITION BY event_type, svc, d ORDER BY hour)"), (19, "latency.", "c")):
    ORACLES[f"d_{_n}"] = f"WITH {E}, {GRID} {COVER} (SELECT {STATUS} AS st, hour % 2 = 0 AS held FROM g)"
    ORACLES[f"d_{_n + 3}"] = f"WITH {E}, {GRID}, p AS (SELECT *, ({_v})::DOUBLE AS point FROM g) SELECT d + hour * 3600 AS time_unix, '{_stem}' || event_type AS MetricName, svc AS ServiceName, point, hour::BIGINT AS typed_value FROM p WHERE {STATUS} = 3 AND hour < 20"
ORACLES["d_6s"], ORACLES["d_24t"], ORACLES["e_11"] = ORACLES["d_6"], ORACLES["d_24b"], ORACLES["d_4"]
ORACLES["d_1s"] = f"WITH {ORDER_SPANS} " + _top({"trace-id": "TraceId", "service-name": "'s' || left(TraceId, 2)", "span-name": "CASE WHEN ParentSpanId = '' THEN 'order' ELSE 'line' END"}, "s", "spans", 5)
ORACLES["d_2r"] = f"WITH {E} SELECT (sec - sec % 86400) * 1000000000 AS bucket_start_nanos, 'event.value' AS MetricName, svc AS service_name, count(*) AS count, round(sum(value), 6) AS sum, min(value) AS min, max(value) AS max, round(avg(value), 6) AS avg, true AS p50_near, true AS p95_near FROM e GROUP BY 1, 3"
for _n, _status, _held in (("d_9", STATUS, "event_id % 2 = 0"), ("d_12", NOTE_STATUS, "false")):
    ORACLES[f"{_n}c"] = ORACLES[_n].replace(f"WITH {E} ", f"WITH {E}, m AS (", 1) + f"), c AS ({COVER} (SELECT {_status} AS st, {_held} AS held FROM e)) SELECT * FROM m, c"
ORACLES["d_14"] = f"""WITH {E}, {GRID}, p AS (SELECT 'gauge' AS kind, event_type FROM e UNION ALL SELECT 'sum', event_type FROM g UNION ALL SELECT 'histogram', event_type FROM g),
 v AS (SELECT kind, 'k' AS key, count(*) FILTER ({STATUS} = 3) AS valid FROM p GROUP BY 1 UNION ALL SELECT kind, 'note', count(*) FILTER ({NOTE_STATUS} = 3) FROM p GROUP BY 1)
 SELECT kind AS metric_kind, key, 'attribute_' || sha256('{{"signal":"metrics","table":"otel_metrics_' || kind || '","location":"point","key":"' || key || '"}}')[:20] AS field_id, 1::BIGINT AS manifest_version, CASE key WHEN 'k' THEN 'eq,gte,lt' ELSE 'eq,starts-with,contains' END AS operators, valid FROM v"""
