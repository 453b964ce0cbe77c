"""Metric series as mergeable parts: a row for each bucket and its dimensions, with a quantile sketch.

Parts of a minute make those of an hour or a day without the points; parts of several batches make one series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .scan import NANOS, dimension

#: Size of a sketch, a few kilobytes; larger is more exact.
SKETCH = 400
PARTS = ["count", "sum", "min", "max", "sketch"]
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def rank_error(size: int = SKETCH) -> float:
    """How far the rank of a sketched quantile is off, as a share of all points, with 99 % confidence; merging does not add to it."""
    return 2.296 / size**0.9723


def start_of(nanos: Column, bucket_nanos: int) -> Column:
    return nanos - F.pmod(nanos, F.lit(bucket_nanos))


def partials(points: DataFrame, bucket_nanos: int, dims: list[str], max_text: int = 128, size: int = SKETCH) -> DataFrame:
    """Points (gauges or sums) as parts: bucket_start_nanos, MetricName, the dimensions, and count, sum, min, max, sketch of Value."""
    groups = [start_of(F.col("time_unix") * NANOS, bucket_nanos).alias("bucket_start_nanos"), F.col("MetricName"), *[dimension(d, max_text).alias(d.replace("-", "_")) for d in dims]]
    v = F.col("Value")
    return points.groupBy(*groups).agg(F.count("*").alias("count"), F.sum(v).alias("sum"), F.min(v).alias("min"), F.max(v).alias("max"), F.kll_sketch_agg_double(v, F.lit(size)).alias("sketch"))


def merged(parts: DataFrame, bucket_nanos: int | None = None, size: int = SKETCH) -> DataFrame:
    """Parts of the same or of longer buckets (``bucket_nanos``, a multiple of theirs)."""
    if bucket_nanos is not None:
        parts = parts.withColumn("bucket_start_nanos", start_of(F.col("bucket_start_nanos"), bucket_nanos))
    keys = [c for c in parts.columns if c not in PARTS]
    return parts.groupBy(*keys).agg(F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def finished(parts: DataFrame, aggregates: list[str]) -> DataFrame:
    """The aggregates of a metric series from its parts."""
    measures = {"count": F.col("count"), "sum": F.col("sum"), "min": F.col("min"), "max": F.col("max"), "avg": F.col("sum") / F.col("count")}
    measures |= {n: F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for n, q in QUANTILES.items()}
    return parts.select(*[c for c in parts.columns if c not in PARTS], *[measures[a].alias(a) for a in aggregates])
