"""Telemetry views of the events, orders and lineitem tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators import typed
from . import schema as s

BOUNDS = [25.0, 50.0, 100.0, 200.0]
DAY = 86_400


def events(spark: SparkSession, d: str) -> DataFrame:
    """events with ``tns``, nanoseconds of the wall clock whatever the session's time zone."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    service = F.concat(F.lit("svc-"), (F.col("user_id") % 5).cast("string"))
    return spark.read.parquet(f"{d}/events.parquet").withColumns({"tns": micros * 1000, "svc": service, "k": F.get_json_object("props", "$.k")})


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores, where its files give fewer: turning records into rows is work for each row, so one small file should not be one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _env() -> Column:
    return F.when(F.col("user_id") % 2 == 0, "prod").otherwise("test")


def spans(spark: SparkSession, d: str) -> DataFrame:
    method = F.when(F.col("event_id") % 2 == 0, "GET").otherwise("POST")
    return events(spark, d).select(
        F.col("tns").alias("timestamp_nanos"), F.lpad(F.col("user_id").cast("string"), 32, "0").alias("TraceId"), F.lpad(F.col("event_id").cast("string"), 16, "0").alias("SpanId"),
        F.lit("").alias("ParentSpanId"), F.col("event_type").alias("SpanName"), F.when(F.col("event_id") % 3 == 0, "Server").otherwise("Internal").alias("SpanKind"), F.col("svc").alias("ServiceName"),
        F.lit("").alias("ScopeName"), F.round(F.col("value") * 1e6).cast("long").alias("Duration"), F.when(F.col("event_type") == "error", "Error").otherwise("Ok").alias("StatusCode"),
        F.create_map(F.lit("http.request.method"), method, F.lit("k"), F.coalesce("k", F.lit(""))).alias("SpanAttributes"), F.create_map(F.lit("deployment.environment.name"), _env()).alias("ResourceAttributes"),
        "event_id", "k",
    )


def order_spans(spark: SparkSession, d: str) -> DataFrame:
    """A root span for each order, a child for each line."""
    nanos = lambda c: F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({c} AS TIMESTAMP_NTZ)) * 1000000000L")
    orders = spark.read.parquet(f"{d}/orders.parquet").select(nanos("o_orderdate").alias("timestamp_nanos"), F.col("o_orderkey").cast("string").alias("TraceId"), F.col("o_orderkey").cast("string").alias("SpanId"), F.lit("").alias("ParentSpanId"), F.lit("order").alias("SpanName"))
    line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select(nanos("l_shipdate").alias("timestamp_nanos"), F.col("l_orderkey").cast("string").alias("TraceId"), line.alias("SpanId"), F.col("l_orderkey").cast("string").alias("ParentSpanId"), F.lit("line").alias("SpanName"))
    return orders.unionByName(lines)


def span_records(spark: SparkSession, d: str) -> DataFrame:
    """Events as raw span records."""
    e = spread(events(spark, d))
    value = lambda **kw: F.struct(*[(kw.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in s.VALUE])
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    attrs = F.array(entry("k", value(int_value=F.col("k").cast("long"))), entry("type", value(string_value=F.col("event_type"))), entry("type", value(string_value=F.upper("event_type"))), entry("odd", value(bool_value=F.col("event_id") % 2 == 1)))
    null = lambda name: F.lit(None).cast(s.SPAN_RECORD[name].dataType).alias(name)
    event = F.when(F.col("event_type") == "purchase", F.array(F.struct((F.col("tns") + 1).alias("timestamp_unix_nano"), F.lit("paid").alias("name"), F.array(entry("k", value(int_value=F.col("k").cast("long")))).alias("attributes"))))
    linked = F.struct(F.lit("root").alias("trace_id"), F.col("event_id").cast("string").alias("span_id"), F.array(F.struct(F.lit("s").alias("key"), F.lit("1").alias("value"))).alias("trace_state"))
    link = F.when(F.col("event_type") == "signup", F.array(F.struct(linked.alias("span_context"), F.array(entry("why", value(string_value=F.lit("first")))).alias("attributes"))))
    return e.select(
        F.col("event_type").alias("name"), F.when(F.col("event_id") % 3 == 0, F.lit("server")).alias("kind"), F.col("tns").alias("start_time_unix_nano"), (F.col("tns") + F.round(F.col("value") * 1e6).cast("long") - 5_000_000).alias("end_time_unix_nano"),
        F.struct(F.lpad(F.col("user_id").cast("string"), 32, "0").alias("trace_id"), F.lpad(F.col("event_id").cast("string"), 16, "0").alias("span_id"), F.array(F.struct(F.lit("a").alias("key"), F.lit("1").alias("value")), F.struct(F.lit("b").alias("key"), F.col("event_type").alias("value"))).alias("trace_state")).alias("span_context"),
        null("parent_span_id"), F.struct(F.array(entry("service.name", value(string_value=F.when(F.col("user_id") % 7 != 0, F.col("svc"))))).alias("attributes"), F.lit(None).cast("string").alias("schema_url")).alias("resource"),
        null("scope"), attrs.alias("attributes"), event.alias("events"), link.alias("links"), F.struct(F.when(F.col("event_type") == "error", F.lit("error")).alias("code"), F.lit(None).cast("string").alias("description")).alias("status"),
    )


def log_records(spark: SparkSession, d: str) -> DataFrame:
    e = spread(events(spark, d))
    value = lambda **kw: F.struct(*[(kw.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in s.VALUE])
    null = lambda name: F.lit(None).cast(s.LOG_RECORD[name].dataType).alias(name)
    is_error = F.col("event_type") == "error"
    attr = F.array(F.struct(F.lit("k").alias("key"), value(int_value=F.col("k").cast("long")).alias("value")), F.struct(F.lit("user.id").alias("key"), value(int_value=F.col("user_id")).alias("value")))
    return e.select(
        F.when(F.col("event_id") % 10 == 0, F.lit(0).cast("long")).otherwise(F.col("tns")).alias("timestamp_unix_nano"), F.col("tns").alias("observed_time_unix_nano"),
        F.lpad(F.col("user_id").cast("string"), 32, "0").alias("trace_id"), F.lpad(F.col("event_id").cast("string"), 16, "0").alias("span_id"), F.lit(257).alias("trace_flags"),
        F.when(is_error, "ERROR").otherwise("INFO").alias("severity_text"), F.when(is_error, 17).otherwise(9).alias("severity_number"), value(json_value=F.col("props")).alias("body"), F.col("event_type").alias("event_name"),
        F.struct(F.array(F.struct(F.lit("service.name").alias("key"), value(string_value=F.col("svc")).alias("value"))).alias("attributes"), F.lit("").alias("schema_url")).alias("resource"), null("scope"), attr.alias("attributes"),
    )


def _metric_columns(df: DataFrame, name: Column, attributes: Column, start: Column, at: Column) -> DataFrame:
    no = F.lit("")
    return df.withColumns({
        "ResourceAttributes": F.create_map(F.lit("service.name"), F.col("svc")), "ResourceSchemaUrl": no, "ScopeName": F.lit("events"), "ScopeVersion": no, "ScopeAttributes": F.create_map().cast("map<string,string>"),
        "ScopeDroppedAttrCount": F.lit(0).cast("long"), "ScopeSchemaUrl": no, "ServiceName": F.col("svc"), "MetricName": name, "MetricDescription": no, "MetricUnit": F.lit("ms"), "Attributes": attributes,
        "start_time_unix": start, "time_unix": at, "Flags": F.lit(0).cast("long"),
    })


def gauges(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumn("Value", F.col("value").cast("double"))
    at = F.floor(F.col("tns") / F.lit(1_000_000_000)).cast("long")
    df = _metric_columns(e, F.lit("event.value"), F.create_map(F.lit("event_type"), F.col("event_type")), at, at)
    return df.withColumn("ResourceAttributes", F.create_map(F.lit("service.name"), F.col("svc"), F.lit("deployment.environment.name"), _env()))


def _grid(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts, bucket counts, sums and extremes for each event type, service and day with events; every hour has a row."""
    e = events(spark, d).withColumns({"sec": F.floor(F.col("tns") / F.lit(1_000_000_000)).cast("long")})
    e = e.withColumns({"day": F.col("sec") - F.pmod("sec", F.lit(DAY)), "hour": F.floor(F.pmod("sec", F.lit(DAY)) / 3600).cast("int") + 1})
    slot = sum((F.col("value") > b).cast("int") for b in BOUNDS)
    hours = e.withColumn("slot", slot).groupBy("event_type", "svc", "day", "hour").agg(
        F.count("*").alias("c"), F.sum("value").alias("v"), F.min("value").alias("lo"), F.max("value").alias("hi"), *[F.count_if(F.col("slot") == i).alias(f"b{i}") for i in range(5)]
    )
    every = hours.select("event_type", "svc", "day").distinct().withColumn("hour", F.explode(F.sequence(F.lit(1), F.lit(24))))
    return every.join(hours, ["event_type", "svc", "day", "hour"], "left").fillna(0, ["c", "v", *[f"b{i}" for i in range(5)]])


def all_sums(spark: SparkSession, d: str) -> DataFrame:
    """Running counts of the day (temporality 2) and hourly counts (temporality 1), from one grid."""
    g, w = _grid(spark, d), Window.partitionBy("event_type", "svc", "day").orderBy("hour")
    g = g.withColumn("both", F.array(F.struct(F.lit(2).alias("t"), F.sum("c").over(w).alias("v")), F.struct(F.lit(1).alias("t"), F.col("c").alias("v"))))
    g = g.select("event_type", "svc", "day", "hour", F.explode("both").alias("b")).withColumn("Value", F.col("b.v").cast("double"))
    g = _metric_columns(g, F.concat(F.lit("events."), "event_type"), F.create_map(F.lit("event_type"), F.col("event_type")), F.col("day"), F.col("day") + F.col("hour") * 3600)
    return g.withColumns({"AggregationTemporality": F.col("b.t"), "IsMonotonic": F.lit(True)})


def sums(spark: SparkSession, d: str, cumulative: bool) -> DataFrame:
    g, w = _grid(spark, d), Window.partitionBy("event_type", "svc", "day").orderBy("hour")
    g = g.withColumn("Value", (F.sum("c").over(w) if cumulative else F.col("c")).cast("double"))
    g = _metric_columns(g, F.concat(F.lit("events."), "event_type"), F.create_map(F.lit("event_type"), F.col("event_type")), F.col("day"), F.col("day") + F.col("hour") * 3600)
    return g.withColumns({"AggregationTemporality": F.lit(2 if cumulative else 1), "IsMonotonic": F.lit(True)})


def histograms(spark: SparkSession, d: str, cumulative: bool) -> DataFrame:
    g, w = _grid(spark, d), Window.partitionBy("event_type", "svc", "day").orderBy("hour")
    run = (lambda c: F.sum(c).over(w)) if cumulative else F.col
    least, most = (F.min("lo").over(w), F.max("hi").over(w)) if cumulative else (F.col("lo"), F.col("hi"))
    g = g.withColumns({
        "Count": run("c").cast("decimal(20,0)"), "Sum": run("v"), "BucketCounts": F.array(*[run(f"b{i}").cast("decimal(20,0)") for i in range(5)]),
        "Min": F.coalesce(least, F.lit(0.0)), "Max": F.coalesce(most, F.lit(0.0)),
    })
    g = g.withColumn("ExplicitBounds", F.array(*map(F.lit, BOUNDS)))
    g = _metric_columns(g, F.concat(F.lit("latency."), "event_type"), F.create_map(F.lit("event_type"), F.col("event_type")), F.col("day"), F.col("day") + F.col("hour") * 3600)
    return g.withColumn("AggregationTemporality", F.lit(2 if cumulative else 1))


def _field(table: str, signal: str, location: str, key: str, kind: str) -> typed.TypedField:
    stem = f"{table.removeprefix('otel_')}_{location}_{key}"
    return typed.TypedField(signal, table, location, key, kind, f"av_{stem}", f"as_{stem}")


def typed_rows(rows: DataFrame, table: str, signal: str, location: str, map_col: str, kind: str) -> tuple[DataFrame, list[typed.TypedField]]:
    """``rows`` (with event_id, k and ``kind``, the event type) with typed k and note: click untyped, view absent, signup note '',
    error k of another type, the others valid; odd ids lose k from the map."""
    fields = [_field(table, signal, location, "k", "int64"), _field(table, signal, location, "note", "string")]
    value = lambda **kw: F.struct(*[(kw.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in s.VALUE])
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    kvalid, note = entry("k", value(int_value=F.col("k").cast("long"))), entry("note", value(string_value=F.concat(F.lit("n-"), F.col(kind))))
    entries = (
        F.when(F.col(kind).isin("click", "view"), F.array().cast(s.ATTRS)).when(F.col(kind) == "signup", F.array(kvalid, entry("note", value(string_value=F.lit("")))))
        .when(F.col(kind) == "error", F.array(entry("k", value(string_value=F.lit("not-an-int"))), note)).otherwise(F.array(kvalid, note))
    )
    out = typed.project_typed(rows.withColumn("_entries", entries), fields, {location: "_entries"}).drop("_entries")
    out = out.withColumns({f.status_column: F.when(F.col(kind) == "click", F.lit(0)).otherwise(F.col(f.status_column)).cast("smallint") for f in fields})
    even = F.map_filter(F.col(map_col), lambda k, v: (k != "k") | (F.col("event_id") % 2 == 0))
    return out.withColumn(map_col, even), fields
