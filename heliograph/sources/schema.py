"""Schemas of the five telemetry tables and of the trace lookup. Nanosecond times are BIGINT; 64-bit unsigned counts are DECIMAL(20,0)."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

S, L, I, D, B, H = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.ShortType()
U64 = T.DecimalType(20, 0)
MAP = T.MapType(S, S)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


SPANS = _struct(
    ("timestamp_nanos", L), ("TraceId", S), ("SpanId", S), ("ParentSpanId", S), ("TraceState", S), ("SpanName", S), ("SpanKind", S), ("ServiceName", S),
    ("ResourceAttributes", MAP), ("ScopeName", S), ("ScopeVersion", S), ("SpanAttributes", MAP), ("Duration", L), ("StatusCode", S), ("StatusMessage", S),
    ("events_timestamp", T.ArrayType(L)), ("events_name", T.ArrayType(S)), ("events_attributes", T.ArrayType(MAP)),
    ("links_trace_id", T.ArrayType(S)), ("links_span_id", T.ArrayType(S)), ("links_trace_state", T.ArrayType(S)), ("links_attributes", T.ArrayType(MAP)),
    ("EventsJSON", S), ("LinksJSON", S),
)
LOGS = _struct(
    ("timestamp_nanos", L), ("TraceId", S), ("SpanId", S), ("TraceFlags", H), ("SeverityText", S), ("SeverityNumber", H), ("ServiceName", S), ("Body", S),
    ("ResourceSchemaUrl", S), ("ResourceAttributes", MAP), ("ScopeSchemaUrl", S), ("ScopeName", S), ("ScopeVersion", S), ("ScopeAttributes", MAP), ("LogAttributes", MAP), ("EventName", S),
)
_METRIC = [
    ("ResourceAttributes", MAP), ("ResourceSchemaUrl", S), ("ScopeName", S), ("ScopeVersion", S), ("ScopeAttributes", MAP), ("ScopeDroppedAttrCount", L), ("ScopeSchemaUrl", S),
    ("ServiceName", S), ("MetricName", S), ("MetricDescription", S), ("MetricUnit", S), ("Attributes", MAP), ("start_time_unix", L), ("time_unix", L),
]
_TAIL = [
    ("Flags", L), ("exemplars_filtered_attributes", T.ArrayType(MAP)), ("exemplars_time_unix", T.ArrayType(L)), ("exemplars_value", T.ArrayType(D)),
    ("exemplars_span_id", T.ArrayType(S)), ("exemplars_trace_id", T.ArrayType(S)),
]
GAUGE = _struct(*_METRIC, ("Value", D), *_TAIL)
SUM = _struct(*_METRIC, ("Value", D), *_TAIL, ("AggregationTemporality", I), ("IsMonotonic", B))
HISTOGRAM = _struct(
    *_METRIC, ("Count", U64), ("Sum", D), ("BucketCounts", T.ArrayType(U64)), ("ExplicitBounds", T.ArrayType(D)), *_TAIL, ("Min", D), ("Max", D), ("AggregationTemporality", I)
)
TRACE_LOOKUP = _struct(("TraceId", S), ("start_unix", L), ("end_unix", L))
TABLES = {"otel_traces": SPANS, "otel_logs": LOGS, "otel_metrics_gauge": GAUGE, "otel_metrics_sum": SUM, "otel_metrics_histogram": HISTOGRAM}

# Input records. Attributes stay arrays of entries, because equal keys may occur twice.
VALUE = _struct(("string_value", S), ("bool_value", B), ("int_value", L), ("double_value", D), ("bytes_value", T.BinaryType()), ("json_value", S))
ATTRS = T.ArrayType(_struct(("key", S), ("value", VALUE)))
RESOURCE = _struct(("attributes", ATTRS), ("schema_url", S))
SCOPE = _struct(("name", S), ("version", S), ("attributes", ATTRS), ("schema_url", S))
STATE = T.ArrayType(_struct(("key", S), ("value", S)))
CONTEXT = _struct(("trace_id", S), ("span_id", S), ("trace_state", STATE))
SPAN_RECORD = _struct(
    ("name", S), ("kind", S), ("start_time_unix_nano", L), ("end_time_unix_nano", L), ("span_context", CONTEXT), ("parent_span_id", S), ("resource", RESOURCE), ("scope", SCOPE), ("attributes", ATTRS),
    ("events", T.ArrayType(_struct(("timestamp_unix_nano", L), ("name", S), ("attributes", ATTRS)))),
    ("links", T.ArrayType(_struct(("span_context", CONTEXT), ("attributes", ATTRS)))), ("status", _struct(("code", S), ("description", S))),
)
LOG_RECORD = _struct(
    ("timestamp_unix_nano", L), ("observed_time_unix_nano", L), ("trace_id", S), ("span_id", S), ("trace_flags", I), ("severity_text", S), ("severity_number", I), ("body", VALUE),
    ("event_name", S), ("resource", RESOURCE), ("scope", SCOPE), ("attributes", ATTRS),
)
POINT = _struct(("start_time_unix_nano", L), ("time_unix_nano", L), ("attributes", ATTRS), ("value", D), ("count", U64), ("sum", D), ("bucket_counts", T.ArrayType(U64)), ("min", D), ("max", D))
METRIC = _struct(("name", S), ("description", S), ("unit", S), ("type", S), ("temporality", S), ("monotonic", B), ("explicit_bounds", T.ArrayType(D)), ("data_points", T.ArrayType(POINT)))
METRIC_RECORD = _struct(("resource", RESOURCE), ("scope_metrics", T.ArrayType(_struct(("scope", SCOPE), ("metrics", T.ArrayType(METRIC))))))


class SchemaMismatch(ValueError):
    """Column names, order or types differ from a table's schema."""


def conform(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """``df`` in the schema's column order; a missing, further or differently typed column fails (typed columns may be named in ``extra``)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in schema}
    odd = [n for n in want if have.get(n) != want[n]] + [n for n in have if n not in want and n not in extra]
    if odd:
        raise SchemaMismatch(f"columns that do not conform: {', '.join(odd)}")
    return df.select(*want, *extra)
