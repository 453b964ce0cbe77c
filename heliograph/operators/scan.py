"""Shared pieces of the queries: window predicates, dimensions and stream identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NANOS = 1_000_000_000


def map_value(m: str, key: str) -> Column:
    """A map's value for a key, '' where it has none."""
    return F.coalesce(F.try_element_at(F.col(m), F.lit(key)), F.lit(""))


#: Each dimension as a column; metrics, spans and logs share these names.
COLUMNS = {
    "service-name": lambda: F.col("ServiceName"), "span-name": lambda: F.col("SpanName"), "span-kind": lambda: F.col("SpanKind"), "status-code": lambda: F.col("StatusCode"),
    "scope-name": lambda: F.col("ScopeName"), "trace-id": lambda: F.col("TraceId"), "severity-text": lambda: F.col("SeverityText"), "event-name": lambda: F.col("EventName"),
    "metric-name": lambda: F.col("MetricName"), "metric-unit": lambda: F.col("MetricUnit"),
    "deployment-environment": lambda: map_value("ResourceAttributes", "deployment.environment.name"), "http-request-method": lambda: map_value("SpanAttributes", "http.request.method"),
}


def dimension(name: str, max_text: int) -> Column:
    return F.left(F.coalesce(COLUMNS[name]().cast("string"), F.lit("")), F.lit(max_text))


def in_window(df: DataFrame, start: int, end: int) -> DataFrame:
    """Half-open window on plain columns, so that file statistics apply; a date partition is bounded too where there is one."""
    if "time_unix" in df.columns:
        # Whole seconds s with start <= s * 10**9 < end.
        df = df.where((F.col("time_unix") >= -(-start // NANOS)) & (F.col("time_unix") <= (end - 1) // NANOS))
    else:
        df = df.where((F.col("timestamp_nanos") >= start) & (F.col("timestamp_nanos") < end))
    if "event_date" in df.columns:
        day = lambda t: F.date_add(F.lit("1970-01-01").cast("date"), F.lit(t // NANOS // 86400))
        df = df.where(F.col("event_date").between(day(start), day(end - 1)))
    return df


def canonical(map_col: str) -> Column:
    """A map as sorted entries, which can be compared, grouped and ordered."""
    return F.array_sort(F.map_entries(F.col(map_col)))


def metric_union(gauge: DataFrame, sum_: DataFrame, histogram: DataFrame) -> DataFrame:
    cols = ["ResourceAttributes", "ScopeName", "ServiceName", "MetricName", "MetricUnit", "Attributes", "time_unix"]
    return gauge.select(cols).unionByName(sum_.select(cols)).unionByName(histogram.select(cols))


def trace_rows(spans: DataFrame, lookup: DataFrame, trace_id: str) -> DataFrame:
    """Spans of one trace: its times from the lookup (one row after aggregation) prune the scan."""
    times = lookup.where(F.col("TraceId") == trace_id).groupBy("TraceId").agg(F.min("start_unix").alias("lo"), F.max("end_unix").alias("hi"))
    hit = times.first()
    if hit is None:
        return spans.where("false")
    return in_window(spans, hit["lo"] * NANOS, (hit["hi"] + 1) * NANOS).where(F.col("TraceId") == trace_id)
