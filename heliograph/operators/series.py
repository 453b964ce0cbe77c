"""Top values and bucketed metric series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.requests import Series, TopValues
from .cuts import cut
from .scan import NANOS, dimension, in_window


def _cells(df: DataFrame, request: TopValues, fields: list[str]) -> DataFrame:
    """(field, value) of every row and field that is not empty."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), dimension(f, request.max_text_length).alias("value")) for f in fields])
    return in_window(df, request.start, request.end).select(F.explode(cells).alias("f")).select("f.field", "f.value").where("value != ''")


def _ranked(counts: DataFrame, request: TopValues) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("count"), "value"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= request.limit).select(F.lit(request.signal).alias("signal"), "field", "value", "count").orderBy("field", F.desc("count"), "value")


def top_values(df: DataFrame, request: TopValues) -> DataFrame:
    """All fields in one pass: a row explodes to its fields, counts are pre-aggregated, and each field keeps its first ``limit``."""
    return _ranked(_cells(df, request, request.fields).groupBy("field", "value").agg(F.count("*").alias("count")), request)


#: Values that a sketch tracks for each field, and how many of them are counted exactly.
TRACKED, PROPOSED = 100_000, 1_000


def top_values_sketched(df: DataFrame, request: TopValues, tracked: int = TRACKED, proposed: int = PROPOSED) -> DataFrame:
    """The rows of ``top_values``, for fields with many distinct values: what is moved is bounded by the sketch.

    A sketch of frequent items proposes values and a second pass counts them exactly. A value that is not proposed comes at
    most as often as the least estimate proposed, or as the sketch's error (3.5 / tracked of a field's rows). Where the last
    of a field's first ``limit`` values comes more often than that, they are certain; fields where it does not, whose values are
    spread evenly, are counted in full.
    """
    proposed = max(proposed, request.limit)
    cells = _cells(df, request, request.fields)
    top = cells.groupBy("field").agg(F.expr(f"approx_top_k(value, {proposed}, {tracked})").alias("top"), F.count("*").alias("n"))
    # A few thousand values a field, of at most ``max_text_length`` characters, and eight fields.
    found = top.select("field", "n", F.array_min(F.col("top.count")).alias("least"), F.col("top.item").alias("items")).collect()
    spark = df.sparkSession
    names = spark.createDataFrame([(r["field"], v) for r in found for v in r["items"]], "field string, value string")
    counts = cells.join(F.broadcast(names), ["field", "value"]).groupBy("field", "value").agg(F.count("*").alias("count"))
    counts = cut(counts)
    facts = {r["field"]: r for r in counts.groupBy("field").agg(F.sum("count").alias("all"), F.sort_array(F.collect_list("count"), asc=False).alias("counts")).select("field", "all", F.get("counts", F.lit(request.limit - 1)).alias("last")).collect()}
    # Either the proposed values are all there are, or the last one wanted comes more often than any other can.
    # A sketch that keeps no value proposes none.
    known = [(r, facts[r["field"]]) for r in found if r["field"] in facts]
    sure = {r["field"] for r, x in known if x["all"] == r["n"] or (x["last"] or 0) > max(3.5 / tracked * r["n"], r["least"])}
    rest = [f for f in request.fields if f not in sure and any(r["field"] == f for r in found)]
    if rest:
        counts = counts.where(~F.col("field").isin(rest)).unionByName(_cells(df, request, rest).groupBy("field", "value").agg(F.count("*").alias("count")))
    return _ranked(counts, request)


def _measures(request: Series, approximate: bool) -> dict[str, Column]:
    if request.kind == "histogram":
        total = F.sum("Count")
        return {"count": total.cast("decimal(38,0)"), "sum": F.sum("Sum"), "avg": F.when(total == 0, 0.0).otherwise(F.sum("Sum") / total.cast("double"))}
    v = F.col("Value")
    quantile = (lambda q: F.percentile_approx(v, q)) if approximate else (lambda q: F.percentile(v, F.lit(q)))
    return {"count": F.count("*"), "sum": F.sum(v), "min": F.min(v), "max": F.max(v), "avg": F.avg(v), "p50": quantile(0.5), "p95": quantile(0.95), "p99": quantile(0.99)}


def group_columns(request: Series, bucket_of: Column | None) -> list[Column]:
    cols = [] if request.bucket_nanos is None or bucket_of is None else [bucket_of.alias("bucket_start_nanos")]
    return cols + [dimension(d, request.max_text_length).alias(d.replace("-", "_")) for d in request.group_by]


def wanted(df: DataFrame, request: Series) -> DataFrame:
    """Points of the metric in the window; of histograms only those with delta temporality."""
    rows = in_window(df, request.start, request.end).where(F.col("MetricName") == request.metric_name)
    return rows.where("AggregationTemporality = 1") if request.kind == "histogram" else rows


def metric_series(df: DataFrame, request: Series, approximate: bool = True) -> DataFrame:
    """Aggregates of the stored points; of histograms only those with delta temporality. No row stands for no points.

    Percentiles are sketched, in bounded memory; exact ones keep a group's distinct values and are made on request.
    """
    rows = wanted(df, request)
    nanos, b = F.col("time_unix") * NANOS, request.bucket_nanos
    groups = group_columns(request, nanos - F.pmod(nanos, F.lit(b)) if b else None)
    measures = _measures(request, approximate)
    names = ["bucket_start_nanos"] * bool(b) + [d.replace("-", "_") for d in request.group_by]
    out = rows.groupBy(*groups).agg(*[measures[a].alias(a) for a in request.aggregates], F.count("*").alias("_n")).where("_n > 0").drop("_n")
    return out if request.limit is None or not names else out.orderBy(*names).limit(request.limit)
