"""Records to rows: spans, logs and metric points as columns of the telemetry tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources import schema as s
from ..sources.text import bound, double_sql, let
from . import typed

NANOS = 1_000_000_000


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _value_sql(v: str) -> str:
    number = let("d_", f"{v}.double_value", double_sql())
    return f"coalesce({v}.string_value, cast({v}.bool_value AS string), cast({v}.int_value AS string), {number}, base64({v}.bytes_value), {v}.json_value, '')"


def value_text(v: Column) -> Column:
    """A typed value as text: doubles as JSON has them, bytes in base64, arrays and maps as their JSON, nothing as ''."""
    return bound(v, "v_", _value_sql("v_"))


def attribute_map(attrs: Column) -> Column:
    """Entries as a map of texts; of equal keys the last wins."""
    texts = f"transform(a_, e_ -> struct(e_.key AS key, {_value_sql('e_.value')} AS text))"
    # Only where a key comes twice is each entry compared with those after it.
    last = "filter(a_, (e_, i_) -> NOT exists(slice(a_, i_ + 2, size(a_)), f_ -> f_.key = e_.key))"
    distinct = let("a_", f"if(size(array_distinct(a_.key)) = size(a_), a_, {last})", f"map_from_entries({texts})")
    named = let("a_", "if(exists(a_, e_ -> e_.key IS NULL), filter(a_, e_ -> e_.key IS NOT NULL), a_)", distinct)
    return bound(attrs, "a_", f"if(a_ IS NULL OR size(a_) = 0, cast(map() AS map<string, string>), {named})")


def _typed(fields: list[typed.TypedField], places: dict[str, str]) -> list[Column]:
    """Value and status columns of typed fields, from the entries column of each location."""
    return [c.alias(n) for f in fields for n, c in typed.project(F.col(places[f.location]), f).items()]


def service_name(resource_map: Column, fallback: str) -> Column:
    return F.coalesce(F.try_element_at(resource_map, F.lit("service.name")), F.lit(fallback))


def enum_label(c: Column, default: str) -> Column:
    v = F.coalesce(c, F.lit(default))
    return F.concat(F.upper(F.substring(v, 1, 1)), F.lower(F.substring(v, 2, 1 << 30)))


def trace_state(state: Column) -> Column:
    return text(F.array_join(F.transform(state, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","))


def uint8(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("int").bitwiseAND(255).cast("smallint")


def whole_seconds(nanos: Column) -> Column:
    """Nanoseconds cut to seconds, exact in 64 bits; nothing is 0."""
    n = F.coalesce(nanos, F.lit(0)).cast("long")
    return F.floor(n.cast("decimal(20,0)") / F.lit(NANOS)).cast("long")


def temporality(c: Column) -> Column:
    return F.when(c == "delta", 1).when(c == "cumulative", 2).otherwise(0)


def _list(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


def spans(records: DataFrame, fallback_service: str = "unknown_service", fields: list[typed.TypedField] = []) -> DataFrame:
    df = records.withColumns({"_resource": attribute_map(F.col("resource.attributes"))})
    events, links = F.coalesce("events", F.array().cast(s.SPAN_RECORD["events"].dataType)), F.coalesce("links", F.array().cast(s.SPAN_RECORD["links"].dataType))
    return df.select(
        F.col("start_time_unix_nano").alias("timestamp_nanos"),
        text(F.col("span_context.trace_id")).alias("TraceId"), text(F.col("span_context.span_id")).alias("SpanId"), text(F.col("parent_span_id")).alias("ParentSpanId"),
        trace_state(F.col("span_context.trace_state")).alias("TraceState"), text(F.col("name")).alias("SpanName"), enum_label(F.col("kind"), "internal").alias("SpanKind"),
        service_name(F.col("_resource"), fallback_service).alias("ServiceName"), F.col("_resource").alias("ResourceAttributes"),
        text(F.col("scope.name")).alias("ScopeName"), text(F.col("scope.version")).alias("ScopeVersion"), attribute_map(F.col("attributes")).alias("SpanAttributes"),
        F.greatest(F.lit(0), F.col("end_time_unix_nano") - F.col("start_time_unix_nano")).cast("long").alias("Duration"),
        enum_label(F.col("status.code"), "unset").alias("StatusCode"), text(F.col("status.description")).alias("StatusMessage"),
        F.transform(events, lambda e: e["timestamp_unix_nano"]).alias("events_timestamp"), F.transform(events, lambda e: text(e["name"])).alias("events_name"),
        F.transform(events, lambda e: attribute_map(e["attributes"])).alias("events_attributes"),
        F.transform(links, lambda e: text(e["span_context"]["trace_id"])).alias("links_trace_id"), F.transform(links, lambda e: text(e["span_context"]["span_id"])).alias("links_span_id"),
        F.transform(links, lambda e: trace_state(e["span_context"]["trace_state"])).alias("links_trace_state"), F.transform(links, lambda e: attribute_map(e["attributes"])).alias("links_attributes"),
        F.to_json(F.transform(events, lambda e: F.struct(e["timestamp_unix_nano"].alias("timestamp"), text(e["name"]).alias("name"), attribute_map(e["attributes"]).alias("attributes")))).alias("EventsJSON"),
        F.to_json(F.transform(links, lambda e: F.struct(text(e["span_context"]["trace_id"]).alias("trace_id"), text(e["span_context"]["span_id"]).alias("span_id"), attribute_map(e["attributes"]).alias("attributes")))).alias("LinksJSON"),
        *_typed(fields, {"resource": "resource.attributes", "scope": "scope.attributes", "span": "attributes"}),
    )


def logs(records: DataFrame, fallback_service: str = "", fields: list[typed.TypedField] = []) -> DataFrame:
    """Event time, or observed time where it is missing or zero."""
    when = F.coalesce(F.nullif(F.col("timestamp_unix_nano"), F.lit(0)), F.col("observed_time_unix_nano"), F.lit(0)).cast("long")
    df = records.withColumns({"_resource": attribute_map(F.col("resource.attributes"))})
    return df.select(
        when.alias("timestamp_nanos"), text(F.col("trace_id")).alias("TraceId"), text(F.col("span_id")).alias("SpanId"), uint8(F.col("trace_flags")).alias("TraceFlags"),
        text(F.col("severity_text")).alias("SeverityText"), uint8(F.col("severity_number")).alias("SeverityNumber"), service_name(F.col("_resource"), fallback_service).alias("ServiceName"),
        value_text(F.col("body")).alias("Body"), text(F.col("resource.schema_url")).alias("ResourceSchemaUrl"), F.col("_resource").alias("ResourceAttributes"),
        text(F.col("scope.schema_url")).alias("ScopeSchemaUrl"), text(F.col("scope.name")).alias("ScopeName"), text(F.col("scope.version")).alias("ScopeVersion"),
        attribute_map(F.col("scope.attributes")).alias("ScopeAttributes"), attribute_map(F.col("attributes")).alias("LogAttributes"), text(F.col("event_name")).alias("EventName"),
        *_typed(fields, {"log": "attributes"}),
    )


def metric_points(records: DataFrame, kind: str | None = None) -> DataFrame:
    """One row for each data point: resource, scope, metric, point. Metrics of other kinds than ``kind`` go before their points are laid out."""
    metrics = F.col("sm.metrics") if kind is None else F.filter("sm.metrics", lambda m: m["type"] == kind)
    df = records.select("resource", F.explode("scope_metrics").alias("sm")).select("resource", F.col("sm.scope").alias("scope"), F.explode(metrics).alias("metric"))
    return df.select("resource", "scope", "metric", F.explode("metric.data_points").alias("point"))


def _metrics(points: DataFrame, kind: str, fallback_service: str, fields: list[typed.TypedField], *own: Column, tail: tuple[Column, ...] = ()) -> DataFrame:
    df = points.where(F.col("metric.type") == kind).withColumn("_resource", attribute_map(F.col("resource.attributes")))
    empty = lambda k: F.array().cast(k)
    return df.select(
        F.col("_resource").alias("ResourceAttributes"), text(F.col("resource.schema_url")).alias("ResourceSchemaUrl"), text(F.col("scope.name")).alias("ScopeName"),
        text(F.col("scope.version")).alias("ScopeVersion"), attribute_map(F.col("scope.attributes")).alias("ScopeAttributes"), F.lit(0).cast("long").alias("ScopeDroppedAttrCount"),
        text(F.col("scope.schema_url")).alias("ScopeSchemaUrl"), service_name(F.col("_resource"), fallback_service).alias("ServiceName"), text(F.col("metric.name")).alias("MetricName"),
        text(F.col("metric.description")).alias("MetricDescription"), text(F.col("metric.unit")).alias("MetricUnit"), attribute_map(F.col("point.attributes")).alias("Attributes"),
        whole_seconds(F.col("point.start_time_unix_nano")).alias("start_time_unix"), whole_seconds(F.col("point.time_unix_nano")).alias("time_unix"), *own,
        F.lit(0).cast("long").alias("Flags"), empty("array<map<string,string>>").alias("exemplars_filtered_attributes"), empty("array<bigint>").alias("exemplars_time_unix"),
        empty("array<double>").alias("exemplars_value"), empty("array<string>").alias("exemplars_span_id"), empty("array<string>").alias("exemplars_trace_id"), *tail,
        *_typed(fields, {"resource": "resource.attributes", "scope": "scope.attributes", "point": "point.attributes"}),
    )


def gauges(points: DataFrame, fallback_service: str = "", fields: list[typed.TypedField] = []) -> DataFrame:
    return _metrics(points, "gauge", fallback_service, fields, F.col("point.value").cast("double").alias("Value"))


def sums(points: DataFrame, fallback_service: str = "", fields: list[typed.TypedField] = []) -> DataFrame:
    tail = (temporality(F.col("metric.temporality")).alias("AggregationTemporality"), F.coalesce("metric.monotonic", F.lit(False)).alias("IsMonotonic"))
    return _metrics(points, "sum", fallback_service, fields, F.col("point.value").cast("double").alias("Value"), tail=tail)


def histograms(points: DataFrame, fallback_service: str = "", fields: list[typed.TypedField] = []) -> DataFrame:
    own = (F.col("point.count").alias("Count"), F.coalesce("point.sum", F.lit(0.0)).alias("Sum"), F.col("point.bucket_counts").alias("BucketCounts"), F.col("metric.explicit_bounds").alias("ExplicitBounds"))
    tail = (F.coalesce("point.min", F.lit(0.0)).alias("Min"), F.coalesce("point.max", F.lit(0.0)).alias("Max"), temporality(F.col("metric.temporality")).alias("AggregationTemporality"))
    return _metrics(points, "histogram", fallback_service, fields, *own, tail=tail)


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def with_violations(rows: DataFrame) -> DataFrame:
    """A ``violations`` array beside each row: codes of values outside their column's domain."""
    checks = []
    for f in rows.schema:
        c, kind = F.col(f.name), f.dataType.simpleString()
        if f.name == "timestamp_nanos" or f.name == "Duration" or kind == "decimal(20,0)":
            checks.append(F.when(c.isNull() | (c < 0), F.lit(f"{f.name}_domain")))
        elif kind == "double":
            checks.append(F.when(~finite(c), F.lit(f"{f.name}_finite")))
        elif kind in ("string", "boolean", "bigint", "smallint", "int"):
            checks.append(F.when(c.isNull(), F.lit(f"{f.name}_missing")))
    return rows.withColumn("violations", F.array_compact(F.array(*checks)))


def split_violations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows with violations)."""
    marked = with_violations(rows)
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def trace_lookup(spans_: DataFrame) -> DataFrame:
    """First and last second of each trace. Blocks may give several rows for a trace: readers aggregate again."""
    times = spans_.where("TraceId != ''").groupBy("TraceId").agg(F.min("timestamp_nanos").alias("lo"), F.max("timestamp_nanos").alias("hi"))
    return times.select("TraceId", whole_seconds(F.col("lo")).alias("start_unix"), whole_seconds(F.col("hi")).alias("end_unix"))
