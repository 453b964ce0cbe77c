"""Forms for large inputs: slices of a stream, sketches, one scan for two results, digests; and what results must look like."""

import pytest
from pyspark.sql import functions as F

from heliograph.operators import cumulative, reports, rollup, series, typed
from heliograph.plans import catalog as q, results
from heliograph.plans.requests import Series, TopValues

from test_cumulative import S, counter_rows

DATA = "/root/testdata/sf0.001"


def stream(spark, n, step=10):
    """One stream of ``n`` snapshots that is started anew every 5,000."""
    rows = spark.range(n).withColumn("epoch", F.floor(F.col("id") / 5000))
    base = counter_rows(spark, [(0, 1, 1)]).drop("start_time_unix", "time_unix", "Value")
    rows = rows.select((F.col("epoch") * 5000 * step).alias("start_time_unix"), ((F.col("id") + 1) * step).alias("time_unix"), ((F.col("id") - F.col("epoch") * 5000 + 1) * 2.0).alias("Value"))
    return base.crossJoin(rows)


def test_one_long_stream_runs_in_many_tasks(spark):
    n = 1_000_000
    request = Series("cumulative-counter", "m", 0, q.END, ["increase", "rate"], limit=None, temporality="cumulative", monotonic=True, limits=q.ALL)
    rows = cumulative.counter_intervals(stream(spark, n), request)
    assert "Window" in rows._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        filled = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("length").alias("length"), F.max("code").alias("code")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(filled) == 4 and max(r.n for r in filled) < 0.5 * n  # all of the session's four shuffle partitions
    out = cumulative.counter_series(stream(spark, n), request).first()
    assert (out.increase, out.interval_count, out.reset_count, out.rate) == (2.0 * n, n, n // 5000, 0.2)


@pytest.mark.parametrize("points, code", [
    ([(0, 10, 5), (0, 20, 4)], "unproven_reset"), ([(5, 10, 5), (0, 20, 6)], "ambiguous_reset"), ([(0, 10, 1), (0, 10, 2)], "ambiguous_order"), ([(0, 12, 5), (15, 18, 2), (0, 40, 9)], "ambiguous_reset"), ([(0, 10, 5), (0, 40, 9), (41, 50, 1)], None),
])
def test_slices_find_what_plain_order_finds(spark, points, code):
    request = Series("cumulative-counter", "m", S * 10**9, (S + 60) * 10**9, ["increase"], temporality="cumulative", monotonic=True)
    df, seen = counter_rows(spark, points), []
    for slice_nanos in (None, 7 * 10**9):
        try:
            row = cumulative.counter_series(df, request, slice_nanos=slice_nanos).first()
            seen.append((row.increase, row.interval_count, row.reset_count))
        except cumulative.TelemetryViolation as e:
            seen.append(e.code)
    assert seen[0] == seen[1] and (code is None or seen[0] == code)


def test_strict_queries_leave_nothing_in_the_cache(spark):
    request = Series("cumulative-counter", "m", S * 10**9, (S + 60) * 10**9, ["increase"], temporality="cumulative", monotonic=True)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert cumulative.counter_series(counter_rows(spark, [(0, 10, 5), (0, 20, 9)]), request).first().increase == 9.0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_rolled_up_quantiles_keep_their_bound(spark):
    # Values of each day are 0 .. 99,999 in an order that has nothing to do with time.
    points = spark.range(3 * 100_000).select(F.lit("m").alias("MetricName"), F.lit("a").alias("ServiceName"), (F.floor(F.col("id") / 100_000) * 86_400 + F.col("id") % 86_400).alias("time_unix"), ((F.col("id") * 7919) % 100_000).cast("double").alias("Value"))
    minutes = rollup.partials(points, 60 * 10**9, ["service-name"])
    days = rollup.merged(rollup.merged(minutes, 3600 * 10**9), 86_400 * 10**9)
    for row in rollup.finished(days, ["count", "sum", "min", "max", "p50", "p95", "p99"]).collect():
        assert (row["count"], row["sum"], row["min"], row["max"]) == (100_000, 99_999 * 50_000.0, 0.0, 99_999.0)
        for name, share in rollup.QUANTILES.items():
            assert abs(row[name] / 100_000 - share) <= 1.5 * rollup.rank_error(), name


@pytest.mark.parametrize("tracked, proposed", [(64, 16), (1000, 100), (100_000, 1000)])
def test_sketched_top_values_are_the_exact_ones(spark, tracked, proposed):
    # One field with a few frequent ids among many, one of even ids, one of few values.
    ids = spark.range(50_000).select(F.when(F.col("id") % 5 == 0, F.concat(F.lit("hot"), F.floor(F.pow(F.col("id") % 60, 0.5)).cast("string"))).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("TraceId"), F.concat(F.lit("n"), (F.col("id") % 5000).cast("string")).alias("SpanName"), F.lit("svc").alias("ServiceName"), F.col("id").alias("timestamp_nanos"))
    request = TopValues("spans", ["trace-id", "span-name", "service-name"], 0, 10**9, 4)
    assert series.top_values_sketched(ids, request, tracked, proposed).collect() == series.top_values(ids, request).collect()


def test_matches_and_coverage_in_one_scan(spark):
    rows, fields = q._typed_spans(spark, DATA)
    found = typed.typed_matches(rows, fields[0], "gte", 50, q.START, q.END, 50, q.ALL)
    assert found.rows._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 1
    matches, coverage = found.answer()
    assert matches == typed.typed_filtered(rows, fields[0], "gte", 50, q.START, q.END, 50, q.ALL).collect()
    assert coverage == typed.typed_coverage(rows, fields[0], q.START, q.END, q.ALL).first().asDict()
    odd = typed.typed_matches(rows.withColumn(fields[0].status_column, F.lit(9).cast("smallint")), fields[0], "gte", 50, q.START, q.END, 50, q.ALL)
    with pytest.raises(typed.UnknownStatus):
        odd.answer()


def test_discovered_bindings_are_accepted_as_they_are(spark):
    _, fields = q._typed_points("gauge")(spark, DATA)
    for row in typed.typed_fields(spark, fields, "otel_metrics_gauge").collect():
        assert typed.bound_field(fields, row.schema_binding).key == row.key
        with pytest.raises(typed.InvalidRequest, match="stale"):
            typed.bound_field(fields, {**row.schema_binding.asDict(), "attribute_type": "boolean"})
        for broken in ({"field_id": "attribute_x"}, {"manifest_version": 1 << 63}, {"manifest_version": 0}, {"attribute_location": "body"}):
            with pytest.raises(typed.InvalidRequest, match="invalid_typed_schema_binding"):
                typed.bound_field(fields, {**row.schema_binding.asDict(), **broken})


def test_one_changed_row_moves_one_range(spark):
    written = spark.range(100_000).select("id", (F.col("id") % 10).alias("day"), F.concat(F.lit("v"), "id").alias("v"), F.create_map(F.lit("a"), F.col("id").cast("string")).alias("m"))
    read = written.withColumn("v", F.when(F.col("id") == 77_777, "lost").otherwise(F.col("v")))
    off = reports.unequal_ranges(*[reports.digest_tree(t, F.col("day"), F.xxhash64("id")) for t in (written, read)]).collect()
    assert [r.day for r in off] == [7]
    inside = written.where((F.col("day") == 7) & (F.pmod(F.xxhash64("id"), F.lit(reports.RANGES)) == off[0].range)).count()
    assert inside < 100  # of 100,000
    got = reports.difference_by_tree(written, read, "day", "xxhash64(id)").select("side", "id", "v").collect()
    assert sorted(map(tuple, got)) == [("read", 77_777, "lost"), ("written", 77_777, "v77777")]
    # Copies count, and equal tables move nothing.
    twice = written.unionAll(written.where("id = 5"))
    assert [(r.side, r.id) for r in reports.difference_by_tree(written, twice, "day", "xxhash64(id)").collect()] == [("read", 5)]
    assert reports.difference_by_tree(written, written, "day", "xxhash64(id)").count() == 0


def test_rows_without_ids_meet_no_span(spark):
    logs = spark.createDataFrame([("", "", "a"), (None, None, "b"), ("t", "s", "c"), ("t", "x", "d")], "TraceId string, SpanId string, Body string")
    spans = spark.createDataFrame([("", "", "root", "svc")] * 50 + [("t", "s", "op", "api")], "TraceId string, SpanId string, SpanName string, ServiceName string")
    assert sorted((r.Body, r.SpanName) for r in reports.correlate(logs, spans).collect() if r.SpanName) == [("c", "op")]
    assert reports.correlate(logs, spans).count() == 4


def test_results_have_their_declared_shape(spark):
    request = Series("gauge", "event.value", q.START, q.END, ["count", "avg", "p95"], ["service-name"], "1h", None, limits=q.ALL)
    df = series.metric_series(q.a.gauges(spark, DATA), request)
    assert results.shaped(df, results.series_shape(request), 128).count() == df.count()
    for odd in (df.drop("avg"), df.withColumn("more", F.lit(1)), df.withColumn("count", F.col("count").cast("int"))):
        with pytest.raises(results.ResultMismatch):
            results.shaped(odd, results.series_shape(request))
    for column, value in (("avg", F.lit(float("nan"))), ("count", F.lit(-1).cast("long")), ("service_name", F.lit("x" * 129)), ("service_name", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match=f"invalid_result {column}"):
            results.shaped(df.withColumn(column, value), results.series_shape(request), 128).collect()
    for kind, more in (("cumulative-counter", {"monotonic": True}), ("cumulative-histogram", {})):
        r = Series(kind, "events.click" if more else "latency.view", q.START, q.END, ["rate"] if more else ["count", "p50"], ["service-name"], limit=None, temporality="cumulative", limits=q.ALL, **more)
        out = cumulative.counter_series(q.a.all_sums(spark, DATA), r) if more else cumulative.histogram_series(q.a.histograms(spark, DATA, True), r)
        assert results.shaped(out, results.series_shape(r)).count() == out.count()
