"""Counters and histograms on small inputs with known answers, and one case for each violation."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from heliograph.operators import cumulative as c
from heliograph.plans.requests import InvalidRequest, Series

S = 1_700_000_000
COMMON = dict(ResourceAttributes={"a": "1", "b": "2"}, ScopeAttributes={}, Attributes={}, ServiceName="api", MetricName="m", MetricUnit="", ResourceSchemaUrl="", ScopeName="", ScopeVersion="", ScopeSchemaUrl="", MetricDescription="", ScopeDroppedAttrCount=0, Flags=0)
BASE = "ResourceAttributes map<string,string>, ScopeAttributes map<string,string>, Attributes map<string,string>, ServiceName string, MetricName string, MetricUnit string, ResourceSchemaUrl string, ScopeName string, ScopeVersion string, ScopeSchemaUrl string, MetricDescription string, ScopeDroppedAttrCount long, Flags long, start_time_unix long, time_unix long, AggregationTemporality int"


def counter_rows(spark, points, **kw):
    rows = [{**COMMON, **kw, "start_time_unix": S + a, "time_unix": S + b, "AggregationTemporality": 2, "Value": float(v), "IsMonotonic": True, **(x[0] if x else {})} for a, b, v, *x in points]
    return spark.createDataFrame(rows, BASE + ", Value double, IsMonotonic boolean")


def counter(**kw):
    return Series(**{"kind": "cumulative-counter", "metric_name": "m", "start": S * 10**9, "end": (S + 60) * 10**9, "aggregates": ["increase", "rate"], "temporality": "cumulative", "monotonic": True, **kw})


def hist_rows(spark, points, bounds=(0.0, 10.0)):
    rows = [{**COMMON, "start_time_unix": S + a, "time_unix": S + b, "AggregationTemporality": 2, "Count": sum(k), "Sum": float(v), "BucketCounts": list(k), "ExplicitBounds": list(x[0] if x else bounds), "Min": -1.0, "Max": 99.0} for a, b, v, k, *x in points]
    df = spark.createDataFrame(rows, BASE + ", Count string, Sum double, BucketCounts array<string>, ExplicitBounds array<double>, Min double, Max double")
    return df.withColumns({"Count": F.col("Count").cast("decimal(20,0)"), "BucketCounts": F.col("BucketCounts").cast("array<decimal(20,0)>")})


def histogram(**kw):
    return Series(**{"kind": "cumulative-histogram", "metric_name": "m", "start": S * 10**9, "end": (S + 60) * 10**9, "aggregates": ["count", "sum", "avg", "p50", "p95"], "temporality": "cumulative", **kw})


def test_counter_with_resets(spark):
    df = counter_rows(spark, [(0, 10, 10), (0, 20, 16), (25, 30, 4), (25, 40, 9), (0, 30, 7, {"IsMonotonic": False}), (0, 35, 7, {"AggregationTemporality": 1})])
    row = c.counter_series(df, counter()).first()
    assert (row.increase, row.interval_count, row.reset_count, row.observed_duration_nanos) == (25.0, 4, 2, 35 * 10**9)
    assert row.rate == pytest.approx(25 / 35)


@pytest.mark.parametrize("code, points, request_", [
    ("ambiguous_order", [(0, 10, 1), (0, 10, 2)], counter()),
    ("unproven_reset", [(0, 10, 5), (0, 20, 4)], counter()),
    ("ambiguous_reset", [(5, 10, 5), (0, 20, 6)], counter()),
    ("ambiguous_projection", [(0, 10, 5), (0, 20, 6, {"Attributes": {"x": "y"}})], counter()),
    ("crosses_bucket", [(-10, 10, 5), (-10, 41, 6)], counter(bucket="1m")),
    ("zero_duration", [(10, 10, 5)], counter()),
    ("invalid_row", [(0, 10, -5)], counter()),
])
def test_counter_violations(spark, code, points, request_):
    if code == "crosses_bucket":  # an interval from 10 to 70 s spans two minutes
        points, request_ = [(-10, 10, 5), (-10, 70, 6)], counter(bucket="1m", end=(S + 100) * 10**9)
    df = counter_rows(spark, points)
    with pytest.raises(c.TelemetryViolation) as e:
        c.counter_series(df, request_)
    assert e.value.code == code
    assert c.counter_series(df, request_, strict=False).count() == 0


def test_equal_maps_in_another_order_are_one_stream(spark):
    df = counter_rows(spark, [(0, 10, 1), (0, 20, 3, {"ResourceAttributes": {"b": "2", "a": "1"}})])
    assert c.counter_series(df, counter()).first().increase == 3.0


def test_histogram_with_resets(spark):
    df = hist_rows(spark, [(0, 10, 20.0, [1, 2, 1]), (0, 20, 44.0, [2, 4, 2]), (25, 30, 21.0, [0, 2, 1]), (25, 40, 39.0, [0, 3, 2])])
    row = c.histogram_series(df, histogram()).first()
    assert (row["count"], row["sum"], row.interval_count, row.reset_count) == (13, 83.0, 4, 2)
    assert (row.p50.rank_numerator, row.p50.rank_denominator, row.p50.in_bucket) == (13, 2, 7)
    assert row.p50.estimate == pytest.approx(45 / 7) and row.p50.max_error == pytest.approx(45 / 7)
    assert row.p95.rank_numerator == 247 and row.p95.lower == 10.0 and row.p95.upper is None and row.p95.estimate is None


def test_histogram_without_counts(spark):
    row = c.histogram_series(hist_rows(spark, [(0, 10, 0.0, [0, 0, 0])]), histogram()).first()
    assert row.avg is None and row.p50 is None and row.interval_count == 1


def test_histogram_counts_beyond_doubles(spark):
    row = c.histogram_series(hist_rows(spark, [(0, 10, 1.0, [2**53, 2**53 + 1])], (0.0,)), histogram()).first()
    assert row.p50.lower == 0.0 and row.p50.in_bucket == 2**53 + 1


@pytest.mark.parametrize("code, points", [
    ("boundary_change", [(0, 10, 1.0, [1, 0, 0]), (0, 20, 1.0, [1, 0, 0], (0.0, 11.0))]),
    ("unproven_reset", [(0, 10, 1.0, [1, 1, 0]), (0, 20, 1.0, [2, 0, 0])]),
    ("ambiguous_order", [(0, 10, 1.0, [1, 0, 0]), (0, 10, 1.0, [1, 0, 0])]),
    ("invalid_row", [(0, 10, float("nan"), [1, 0, 0])]),
])
def test_histogram_violations(spark, code, points):
    with pytest.raises(c.TelemetryViolation) as e:
        c.histogram_series(hist_rows(spark, points), histogram())
    assert e.value.code == code


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 5), st.booleans()), min_size=1, max_size=12))
def test_counter_model(spark, steps):
    """Increments, durations and proven resets: the increase is the sum of the increments."""
    at = value = start = total = 0
    points = []
    for add, length, reset in steps:
        if reset and points:
            start, value = at, 0
        at, value, total = at + length, value + add, total + add
        points.append((start, at, value))
    row = c.counter_series(counter_rows(spark, points), counter(end=(S + 100) * 10**9)).first()
    assert row.increase == total and row.interval_count == len(points)


@pytest.mark.parametrize("bad", [
    dict(start=5, end=5), dict(start=-1), dict(end=S * 10**9 + 25 * 3600 * 10**9), dict(metric_name=" "), dict(metric_name="x" * 257), dict(aggregates=[]), dict(aggregates=["p50"]),
    dict(group_by=["nope"]), dict(group_by=["service-name"] * 2), dict(bucket="2m"), dict(limit=0), dict(limit=101), dict(temporality=None), dict(monotonic=None), dict(max_text_length=0),
])
def test_requests_fail_before_any_job(bad):
    with pytest.raises(InvalidRequest):
        counter(**bad)


def test_unknown_keys_are_rejected():
    with pytest.raises(TypeError):
        counter(colour="red")
