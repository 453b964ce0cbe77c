"""Metric series of a stream: event-time windows that are published once, when the watermark has passed them.

The watermark is the latest point of earlier batches less a delay. Points of windows that it has passed are late: they go
to a table of their own instead of being dropped. The others are added up to mergeable parts, batch by batch; a window that
the watermark passes is merged from its parts and published. A batch that runs again writes the same rows to the same place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators import rollup
from ..operators.scan import NANOS
from ..operators.series import wanted
from ..plans.requests import InvalidRequest, Series
from . import commits

STREAM = "windows"


def _closed(request: Series, watermark: int | None):
    """Windows that end at or before a watermark in seconds; none before there is one."""
    end = F.col("bucket_start_nanos") + request.bucket_nanos
    return F.lit(False) if watermark is None else end <= F.lit(watermark * NANOS)


def _parts(spark: SparkSession, path: str, number: int) -> DataFrame:
    """Parts of this batch and of finished ones before it."""
    own = spark.read.parquet(f"{path}/parts/batch={number}")
    before = commits.read_batches(spark, path, "parts", STREAM)
    return own if before is None else own.unionByName(before.where(F.col("batch") < number).drop("batch"))


def _watermark(spark: SparkSession, path: str, number: int, delay: int) -> int | None:
    latest = commits.committed(spark, path, STREAM).where(F.col("batch") < number).agg(F.max("max_time")).first()[0]
    return None if latest is None else latest - delay


def write_windows(batch: DataFrame, path: str, number: int, request: Series, delay: int) -> None:
    """One batch of points into ``parts``, ``late`` and ``series`` under ``path``."""
    spark = batch.sparkSession
    rows = wanted(batch, request)
    before = _watermark(spark, path, number, delay)
    start = rollup.start_of(F.col("time_unix") * NANOS, request.bucket_nanos)
    late = _closed(request, before)
    rows.withColumn("bucket_start_nanos", start).where(late).drop("bucket_start_nanos").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
    timely = rows.withColumn("bucket_start_nanos", start).where(~late).drop("bucket_start_nanos")
    rollup.partials(timely, request.bucket_nanos, request.group_by, request.max_text_length).write.mode("overwrite").parquet(f"{path}/parts/batch={number}")
    seen, latest = rows.agg(F.count("*"), F.max("time_unix")).first()
    after = max((x for x in (before, None if latest is None else latest - delay) if x is not None), default=None)
    ready = _parts(spark, path, number).where(_closed(request, after) & ~_closed(request, before))
    rollup.finished(rollup.merged(ready), request.aggregates).write.mode("overwrite").parquet(f"{path}/series/batch={number}")
    commits.commit(spark, path, STREAM, number, seen, None if after is None else after + delay)


def window_stream(points: DataFrame, path: str, checkpoint: str, request: Series, delay_seconds: int = 0) -> DataStreamWriter:
    """Gauges or sums, streamed, as a series of ``request`` (which names a bucket) under ``path``."""
    if request.kind not in ("gauge", "sum") or request.bucket_nanos is None:
        raise InvalidRequest("invalid_bucket")

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            if not kept.isEmpty():
                write_windows(kept, path, number, request, delay_seconds)
        finally:
            kept.unpersist()

    return points.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The windows that have been published; nothing before the first batch."""
    rows = commits.read_batches(spark, path, "series", STREAM)
    return None if rows is None else rows.drop("batch")


def late_points(spark: SparkSession, path: str) -> DataFrame | None:
    rows = commits.read_batches(spark, path, "late", STREAM)
    return None if rows is None else rows.drop("batch")


def open_windows(spark: SparkSession, path: str, request: Series, delay_seconds: int = 0) -> DataFrame | None:
    """Windows that are not published yet, as far as they have come."""
    rows = commits.read_batches(spark, path, "parts", STREAM)
    if rows is None:
        return None
    passed = _watermark(spark, path, 1 << 62, delay_seconds)
    return rollup.finished(rollup.merged(rows.drop("batch").where(~_closed(request, passed))), request.aggregates)
