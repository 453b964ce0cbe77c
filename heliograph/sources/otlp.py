"""OTLP JSON as exporters send it (resourceSpans, resourceLogs, resourceMetrics) as the records of ``schema``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import schema as s
from .text import bound, double_sql, let

# Names of the format, and of its numbered kinds.
_VALUE = "variant"
KINDS = ["internal", "server", "client", "producer", "consumer"]
STATUS = ["unset", "ok", "error"]
TEMPORALITY = ["unspecified", "delta", "cumulative"]


_ATTRS = f"array<struct<key string, value {_VALUE}>>"
_RESOURCE = f"struct<attributes {_ATTRS}>"
_SCOPE = f"struct<name string, version string, attributes {_ATTRS}>"
_EVENT = f"struct<timeUnixNano string, name string, attributes {_ATTRS}>"
_LINK = f"struct<traceId string, spanId string, traceState string, attributes {_ATTRS}>"
_SPAN = f"struct<traceId string, spanId string, traceState string, parentSpanId string, name string, kind string, startTimeUnixNano string, endTimeUnixNano string, attributes {_ATTRS}, events array<{_EVENT}>, links array<{_LINK}>, status struct<code string, message string>>"
_LOG = f"struct<timeUnixNano string, observedTimeUnixNano string, traceId string, spanId string, flags int, severityText string, severityNumber int, eventName string, body {_VALUE}, attributes {_ATTRS}>"
_POINT = f"struct<startTimeUnixNano string, timeUnixNano string, attributes {_ATTRS}, asDouble double, asInt string, count string, sum double, bucketCounts array<string>, explicitBounds array<double>, min double, max double>"
_DATA = f"struct<dataPoints array<{_POINT}>, aggregationTemporality string, isMonotonic boolean>"
_METRIC = f"struct<name string, description string, unit string, gauge {_DATA}, sum {_DATA}, histogram {_DATA}>"
SCHEMAS = {
    "spans": f"resourceSpans array<struct<resource {_RESOURCE}, schemaUrl string, scopeSpans array<struct<scope {_SCOPE}, schemaUrl string, spans array<{_SPAN}>>>>>",
    "logs": f"resourceLogs array<struct<resource {_RESOURCE}, schemaUrl string, scopeLogs array<struct<scope {_SCOPE}, schemaUrl string, logRecords array<{_LOG}>>>>>",
    "metrics": f"resourceMetrics array<struct<resource {_RESOURCE}, schemaUrl string, scopeMetrics array<struct<scope {_SCOPE}, schemaUrl string, metrics array<{_METRIC}>>>>>",
}


#: Arrays and maps within each other are written out down to this depth; what lies deeper stays as the format has it.
DEPTH = 5


def _get(name: str, kind: str) -> str:
    return f"try_variant_get(v_, '$.{name}', '{kind}')"


def _quoted(text: str) -> str:
    """SQL of a text as JSON, null for none."""
    return f"if({text} IS NULL, NULL, substr(to_json(array({text})), 2, length(to_json(array({text}))) - 2))"


def _nested(depth: int) -> str:
    """SQL of an array or a map ``v_`` as JSON, null where the value is neither. Items and entries are laid out alike, so each level is one pass."""
    scalar = ", ".join([_quoted(_get("stringValue", "string")), f"cast({_get('boolValue', 'boolean')} AS string)", f"cast({_get('intValue', 'bigint')} AS string)", let("d_", _get("doubleValue", "double"), double_sql()), _quoted(_get("bytesValue", "string"))])
    inner = f"coalesce({scalar}, {_nested(depth - 1) if depth else 'to_json(v_)'}, 'null')"
    part = f"concat(if(e_.key IS NULL, '', concat({_quoted('e_.key')}, ':')), {let('v_', 'e_.value', inner)})"
    items = "transform(a_.items.values, x_ -> struct(cast(NULL AS string) AS key, x_ AS value))"
    body = f"array_join(transform(coalesce({items}, a_.entries.values, array()), e_ -> {part}), ',')"
    both = f"struct({_get('arrayValue', 'struct<values:array<variant>>')} AS items, {_get('kvlistValue', 'struct<values:array<struct<key:string,value:variant>>>')} AS entries)"
    return let("a_", both, f"if(a_.items IS NULL AND a_.entries IS NULL, NULL, concat(if(a_.items IS NULL, '{{', '['), {body}, if(a_.items IS NULL, '}}', ']')))")


def _value(v: Column) -> Column:
    return bound(
        v, "v_",
        f"struct({_get('stringValue', 'string')} AS string_value, {_get('boolValue', 'boolean')} AS bool_value, {_get('intValue', 'bigint')} AS int_value, {_get('doubleValue', 'double')} AS double_value, "
        f"unbase64({_get('bytesValue', 'string')}) AS bytes_value, {_nested(DEPTH)} AS json_value)",
    )


def _attrs(c: Column) -> Column:
    return F.transform(c, lambda e: F.struct(e["key"].alias("key"), _value(e["value"]).alias("value")))


def _name(c: Column, names: list[str], first: int, prefix: str) -> Column:
    """A numbered kind, given by number or by name."""
    by_number = F.get(F.array(*map(F.lit, names)), c.cast("int") - first)
    return F.when(c.rlike("^[0-9]+$"), F.when(c.cast("int") >= first, by_number)).otherwise(F.lower(F.regexp_replace(c, f"^{prefix}", "")))


def _state(c: Column) -> Column:
    pairs = F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: x.contains("="))
    return F.transform(pairs, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("key"), F.regexp_replace(x, "^[^=]*=", "").alias("value")))


def _context(v: Column) -> Column:
    return F.struct(v["traceId"].alias("trace_id"), v["spanId"].alias("span_id"), _state(v["traceState"]).alias("trace_state"))


def _resource(r: str) -> Column:
    return F.struct(_attrs(F.col(f"{r}.resource.attributes")).alias("attributes"), F.col(f"{r}.schemaUrl").alias("schema_url")).alias("resource")


def _scope(x: Column) -> Column:
    return F.struct(x["scope"]["name"].alias("name"), x["scope"]["version"].alias("version"), _attrs(x["scope"]["attributes"]).alias("attributes"), x["schemaUrl"].alias("schema_url"))


def lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """(line): requests as they come, one a line."""
    return (spark.readStream if stream else spark.read).text(path).select(F.col("value").alias("line"))


# What a request of each signal holds.
ROOTS = {"spans": "resourceSpans", "logs": "resourceLogs", "metrics": "resourceMetrics"}


def requests(lines_: DataFrame, signal: str) -> DataFrame:
    """(line, request, reason): each line that is not blank as a request, or the reason why it is none.

    ``malformed``: no JSON, or not of the format's types. ``no_request``: JSON without what a request of the signal holds.
    """
    root = ROOTS[signal]
    schema = f"{SCHEMAS[signal]}, _broken string"
    parsed = lines_.where(F.trim("line") != "").select("line", F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("request"))
    reason = F.when(F.col("request").isNull() | F.col("request._broken").isNotNull(), "malformed").when(F.col(f"request.{root}").isNull(), "no_request")
    return parsed.withColumn("reason", reason)


def rejects(requests_: DataFrame) -> DataFrame:
    """(line, reason) of the lines that are no requests."""
    return requests_.where("reason IS NOT NULL").select("line", "reason")


def _good(requests_: DataFrame, signal: str) -> DataFrame:
    return requests_.where("reason IS NULL").select(F.explode(f"request.{ROOTS[signal]}").alias("r"))


def read_spans(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Records like ``schema.SPAN_RECORD``, one for each span of each request (a JSON line); ``rejects`` has the other lines."""
    return span_records(requests(lines(spark, path, stream), "spans"))


def span_records(requests_: DataFrame) -> DataFrame:
    df = _good(requests_, "spans").select("r", F.explode("r.scopeSpans").alias("s")).select("r", "s", F.explode("s.spans").alias("v"))
    v = F.col("v")
    return df.select(
        v["name"].alias("name"), _name(v["kind"], KINDS, 1, "SPAN_KIND_").alias("kind"), v["startTimeUnixNano"].cast("long").alias("start_time_unix_nano"), v["endTimeUnixNano"].cast("long").alias("end_time_unix_nano"),
        _context(v).alias("span_context"), v["parentSpanId"].alias("parent_span_id"), _resource("r"), _scope(F.col("s")).alias("scope"), _attrs(v["attributes"]).alias("attributes"),
        F.transform(v["events"], lambda e: F.struct(e["timeUnixNano"].cast("long").alias("timestamp_unix_nano"), e["name"].alias("name"), _attrs(e["attributes"]).alias("attributes"))).alias("events"),
        F.transform(v["links"], lambda e: F.struct(_context(e).alias("span_context"), _attrs(e["attributes"]).alias("attributes"))).alias("links"),
        F.struct(_name(v["status"]["code"], STATUS, 0, "STATUS_CODE_").alias("code"), v["status"]["message"].alias("description")).alias("status"),
    )


def read_logs(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Records like ``schema.LOG_RECORD``."""
    return log_records(requests(lines(spark, path, stream), "logs"))


def log_records(requests_: DataFrame) -> DataFrame:
    df = _good(requests_, "logs").select("r", F.explode("r.scopeLogs").alias("s")).select("r", "s", F.explode("s.logRecords").alias("v"))
    v = F.col("v")
    return df.select(
        v["timeUnixNano"].cast("long").alias("timestamp_unix_nano"), v["observedTimeUnixNano"].cast("long").alias("observed_time_unix_nano"), v["traceId"].alias("trace_id"), v["spanId"].alias("span_id"), v["flags"].alias("trace_flags"),
        v["severityText"].alias("severity_text"), v["severityNumber"].alias("severity_number"), _value(v["body"]).alias("body"), v["eventName"].alias("event_name"), _resource("r"), _scope(F.col("s")).alias("scope"), _attrs(v["attributes"]).alias("attributes"),
    )


def read_metrics(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Records like ``schema.METRIC_RECORD``."""
    return metric_records(requests(lines(spark, path, stream), "metrics"))


def metric_records(requests_: DataFrame) -> DataFrame:
    def metric(m: Column) -> Column:
        kind = F.when(m["gauge"].isNotNull(), "gauge").when(m["sum"].isNotNull(), "sum").when(m["histogram"].isNotNull(), "histogram")
        data = F.coalesce(m["gauge"], m["sum"], m["histogram"])
        points = F.transform(
            data["dataPoints"],
            lambda p: F.struct(
                p["startTimeUnixNano"].cast("long").alias("start_time_unix_nano"), p["timeUnixNano"].cast("long").alias("time_unix_nano"), _attrs(p["attributes"]).alias("attributes"), F.coalesce(p["asDouble"], p["asInt"].cast("double")).alias("value"),
                p["count"].cast("decimal(20,0)").alias("count"), p["sum"].alias("sum"), F.transform(p["bucketCounts"], lambda c: c.cast("decimal(20,0)")).alias("bucket_counts"), p["min"].alias("min"), p["max"].alias("max"),
            ),
        )
        return F.struct(
            m["name"].alias("name"), m["description"].alias("description"), m["unit"].alias("unit"), kind.alias("type"), _name(data["aggregationTemporality"], TEMPORALITY, 0, "AGGREGATION_TEMPORALITY_").alias("temporality"),
            data["isMonotonic"].alias("monotonic"), F.get(data["dataPoints"], F.lit(0))["explicitBounds"].alias("explicit_bounds"), points.alias("data_points"),
        )

    df = _good(requests_, "metrics")
    scopes = F.transform(F.col("r.scopeMetrics"), lambda x: F.struct(_scope(x).alias("scope"), F.transform(x["metrics"], metric).alias("metrics")))
    return df.select(_resource("r"), scopes.alias("scope_metrics"))


RECORDS_OF = {"spans": span_records, "logs": log_records, "metrics": metric_records}
RECORDS = {"spans": s.SPAN_RECORD, "logs": s.LOG_RECORD, "metrics": s.METRIC_RECORD}
