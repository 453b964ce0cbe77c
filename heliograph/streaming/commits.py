"""Markers of finished batches: what a batch wrote to several tables becomes visible at once, and only when all of it is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.scan import canonical
from ..sources import schema as s

MARKER = "batch long, written_at timestamp, rows long, max_time long"
#: The stream whose batches write a table.
STREAMS = {"otel_traces": "spans", "otel_traces_trace_id_ts": "spans", "otel_logs": "logs", "otel_metrics_gauge": "metrics", "otel_metrics_sum": "metrics", "otel_metrics_histogram": "metrics"}
#: What makes a record one that has been read before; others have no identity but all of their columns.
RECORD_IDS = {"otel_traces": ["TraceId", "SpanId"]}


def _folder(path: str, stream: str) -> str:
    return f"{path}/commits/stream={stream}"


def _read(read: Callable[[str], DataFrame], path: str) -> DataFrame | None:
    """What is at ``path``, None where nothing has been written yet."""
    try:
        return read(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def commit(spark: SparkSession, path: str, stream: str, number: str | int, rows: int | None = None, max_time: int | None = None) -> None:
    """Mark a batch as whole, after all its tables are written. A batch that is written again is marked again."""
    one = spark.range(1).select(F.current_timestamp().alias("written_at"), F.lit(rows).cast("long").alias("rows"), F.lit(max_time).cast("long").alias("max_time"))
    one.coalesce(1).write.mode("overwrite").json(f"{_folder(path, stream)}/batch={number}")


def committed(spark: SparkSession, path: str, stream: str) -> DataFrame:
    """The markers of a stream, one row for each finished batch."""
    rows = _read(spark.read.schema(MARKER).json, _folder(path, stream))
    return spark.createDataFrame([], MARKER) if rows is None else rows.select("batch", "written_at", "rows", "max_time")


def read_batches(spark: SparkSession, path: str, table: str, stream: str) -> DataFrame | None:
    """Rows of a table's finished batches, with their ``batch``; nothing where no batch has been finished.

    Batches are partitions, so those without a marker are not opened.
    """
    done = committed(spark, path, stream).select("batch")
    rows = None if done.isEmpty() else _read(spark.read.option("mergeSchema", "true").parquet, f"{path}/{table}")
    if rows is None:
        return None
    # Markers are a few bytes a batch.
    return rows.withColumn("batch", F.col("batch").cast("long")).join(F.broadcast(done), "batch", "left_semi")


def read_table(spark: SparkSession, path: str, table: str, distinct: bool = False) -> DataFrame:
    """A telemetry table as readers see it: rows of finished batches only.

    ``distinct``: of records that a sender has sent again one is kept, of spans by their ids, of others by all columns.
    """
    rows = read_batches(spark, path, table, STREAMS[table])
    if rows is None:
        return spark.createDataFrame([], s.TABLES.get(table, s.TRACE_LOOKUP))
    if not distinct:
        return rows.drop("batch")
    ids = RECORD_IDS.get(table)
    if ids is None:
        plain = [canonical(f.name) if isinstance(f.dataType, T.MapType) else F.to_json(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in rows.schema if f.name != "batch"]
        rows, ids = rows.withColumns({f"_id{i}": F.xxhash64(F.lit(i), *plain) for i in (0, 1)}), ["_id0", "_id1"]
    # The first delivery stays.
    first = rows.groupBy(*ids).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in ids]), "batch").alias("_r"))
    names = [c for c in rows.columns if c not in ("batch", "_id0", "_id1")]
    return first.select(*[F.col(c) if c in ids else F.col(f"_r.{c}").alias(c) for c in names])
