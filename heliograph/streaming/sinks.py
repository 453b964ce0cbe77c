"""Streaming ingestion into the telemetry tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..operators import ingest, typed
from ..sources import otlp, schema as s
from .commits import commit

Fields = Sequence[typed.TypedField]
SORT = {"otel_traces": ["ServiceName", "SpanName", "timestamp_nanos"], "otel_logs": ["five_minutes", "ServiceName", "timestamp_nanos"]}


def read_records(spark: SparkSession, path: str, schema: StructType, stream: bool = False) -> DataFrame:
    """OTLP-shaped JSON records with a fixed schema."""
    return (spark.readStream if stream else spark.read).schema(schema).json(path)


def dated(df: DataFrame) -> DataFrame:
    at = F.col("timestamp_nanos") if "timestamp_nanos" in df.columns else F.col("time_unix") * F.lit(1_000_000_000)
    return df.withColumn("event_date", F.date_add(F.lit("1970-01-01").cast("date"), F.floor(at / F.lit(86_400_000_000_000)).cast("int")))


def append(df: DataFrame, path: str, table: str, batch: str | None = None, fields: Fields = ()) -> None:
    """Append rows, with the typed columns of ``fields``, partitioned by date and sorted inside files; a named batch overwrites its own directory only, so a retry adds nothing."""
    out = dated(s.conform(df, s.TABLES[table], tuple(typed.expected_columns([*fields]))))
    if table == "otel_logs":
        out = out.withColumn("five_minutes", F.floor(F.col("timestamp_nanos") / F.lit(300_000_000_000)))
    out = out.sortWithinPartitions(*SORT.get(table, ["ServiceName", "MetricName", "time_unix"])).drop("five_minutes")
    target = f"{path}/{table}" + (f"/batch={batch}" if batch is not None else "")
    out.write.mode("append" if batch is None else "overwrite").partitionBy("event_date").option("compression", "zstd").parquet(target)


def append_lookup(spans: DataFrame, path: str, batch: str | None = None) -> None:
    lookup = ingest.trace_lookup(spans).withColumn("start_date", F.to_date(F.timestamp_seconds("start_unix")))
    target = f"{path}/otel_traces_trace_id_ts" + (f"/batch={batch}" if batch is not None else "")
    writer = lookup.write.mode("append" if batch is None else "overwrite").partitionBy("start_date")
    writer.option("parquet.bloom.filter.enabled#TraceId", "true").parquet(target)


def _each(path: str, stream: str, write: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
    """Each batch that has rows is written to all its tables, then marked as whole. An empty batch publishes nothing."""

    def run(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            if rows := kept.count():
                write(kept, str(number))
                commit(batch.sparkSession, path, stream, number, rows)
        finally:
            kept.unpersist()

    return run


def _store(rows: DataFrame, path: str, table: str, number: str, fields: Fields, also: Callable[[DataFrame], None] | None = None) -> None:
    """Valid rows into their table (and to ``also``), the others with their violations beside it. Records are turned into rows once."""
    marked = ingest.with_violations(rows).persist()
    try:
        good = marked.where(F.size("violations") == 0).drop("violations")
        append(good, path, table, number, fields)
        if also is not None:
            also(good)
        marked.where(F.size("violations") > 0).write.mode("overwrite").parquet(f"{path}/rejected/{table}/batch={number}")
    finally:
        marked.unpersist()


def _of(fields: Fields, table: str) -> list[typed.TypedField]:
    return [f for f in fields if f.table == table]


def write_spans(records: DataFrame, path: str, number: str, fields: Fields = ()) -> None:
    own = _of(fields, "otel_traces")
    _store(ingest.spans(records, fields=own), path, "otel_traces", number, own, lambda good: append_lookup(good, path, number))


def write_logs(records: DataFrame, path: str, number: str, fields: Fields = ()) -> None:
    own = _of(fields, "otel_logs")
    _store(ingest.logs(records, fields=own), path, "otel_logs", number, own)


def write_metrics(records: DataFrame, path: str, number: str, fields: Fields = ()) -> None:
    for kind, rows in (("gauge", ingest.gauges), ("sum", ingest.sums), ("histogram", ingest.histograms)):
        table = f"otel_metrics_{kind}"
        own = _of(fields, table)
        _store(rows(ingest.metric_points(records, kind), fields=own), path, table, number, own)


WRITE = {"spans": write_spans, "logs": write_logs, "metrics": write_metrics}


def _stream(signal: str, records: DataFrame, path: str, checkpoint: str, fields: Fields) -> DataStreamWriter:
    each = _each(path, signal, lambda batch, number: WRITE[signal](batch, path, number, fields))
    return records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)


def span_stream(records: DataFrame, path: str, checkpoint: str, fields: Fields = ()) -> DataStreamWriter:
    return _stream("spans", records, path, checkpoint, fields)


def log_stream(records: DataFrame, path: str, checkpoint: str, fields: Fields = ()) -> DataStreamWriter:
    return _stream("logs", records, path, checkpoint, fields)


def metric_stream(records: DataFrame, path: str, checkpoint: str, fields: Fields = ()) -> DataStreamWriter:
    return _stream("metrics", records, path, checkpoint, fields)


def request_stream(lines: DataFrame, signal: str, path: str, checkpoint: str, fields: Fields = ()) -> DataStreamWriter:
    """OTLP JSON requests, a line each, into the tables of ``signal``; lines that are no request go, as they are, to ``rejected/requests_<signal>``."""

    def write(batch: DataFrame, number: str) -> None:
        requests = otlp.requests(batch, signal)
        otlp.rejects(requests).write.mode("overwrite").parquet(f"{path}/rejected/requests_{signal}/batch={number}")
        WRITE[signal](otlp.RECORDS_OF[signal](requests), path, number, fields)

    return lines.writeStream.foreachBatch(_each(path, signal, write)).option("checkpointLocation", checkpoint)
