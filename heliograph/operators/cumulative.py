"""Reset-aware differencing of cumulative counters and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.requests import Series
from .cuts import cut
from .ingest import finite
from .scan import NANOS, canonical, dimension, in_window


class TelemetryViolation(ValueError):
    """Snapshots that contradict a cumulative stream; carries the code alone."""

    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


# The columns of a stream's identity. Counters leave out description and dropped-attribute count.
COUNTER_KEY = ["ServiceName", "MetricName", "MetricUnit", "ResourceSchemaUrl", "ScopeName", "ScopeVersion", "ScopeSchemaUrl"]
HISTOGRAM_KEY = [*COUNTER_KEY, "MetricDescription", "ScopeDroppedAttrCount"]
MAPS = ["ResourceAttributes", "ScopeAttributes", "Attributes"]
# Violation codes in the order they are raised. Only streams have late rows.
CODES = ["invalid_row", "ambiguous_projection", "boundary_change", "ambiguous_order", "ambiguous_reset", "unproven_reset", "invalid_extrema", "zero_duration", "crosses_bucket", "late_row"]
#: A stream is differenced in slices of this length, each in a task of its own.
SLICE = 86_400 * NANOS
#: What a snapshot hands on to the next one of its stream, besides its times.
COUNTER_STATE = ["Value"]
HISTOGRAM_STATE = ["BucketCounts", "Count", "Sum", "Min", "Max"]
DEC = "decimal(38,0)"


def _rows(df: DataFrame, request: Series, key: list[str]) -> DataFrame:
    """Snapshots in the window with their stream key and dimensions. The window comes first: a stream's first row in it is its base."""
    rows = in_window(df, request.start, request.end).where((F.col("MetricName") == request.metric_name) & (F.col("AggregationTemporality") == 2))
    identity = [*map(F.col, key), *map(canonical, MAPS)]
    # 128 bits of the identity.
    stream = F.struct(F.xxhash64(F.lit(1), *identity).alias("x"), F.xxhash64(F.lit(2), *identity).alias("y"))
    dims = {d.replace("-", "_"): dimension(d, request.max_text_length) for d in request.group_by}
    return rows.withColumns({"stream": stream, "t": F.col("time_unix") * NANOS, "s": F.col("start_time_unix") * NANOS, **dims})


def _before(rows: DataFrame, request: Series, state: list[str], slice_nanos: int | None) -> DataFrame:
    """``rows`` with ``p``, the snapshot before each in its stream.

    Slices of a stream are ordered apart from each other. The last snapshot of each goes to the first of the next, one row
    for each slice, so a stream without end is no task without end.
    """
    snapshot = F.struct("t", "s", *state)
    if slice_nanos is None or request.end - request.start <= slice_nanos:
        return rows.withColumn("p", F.lag(snapshot).over(Window.partitionBy("stream").orderBy("t")))
    rows = rows.withColumn("slice", F.col("t") - F.pmod(F.col("t"), F.lit(slice_nanos)))
    last = rows.groupBy("stream", "slice").agg(F.max_by(snapshot, "t").alias("last"))
    handed = last.select("stream", "slice", F.lag("last").over(Window.partitionBy("stream").orderBy("slice")).alias("handed")).where("handed IS NOT NULL")
    rows = rows.withColumn("p", F.lag(snapshot).over(Window.partitionBy("stream", "slice").orderBy("t")))
    return rows.join(handed, ["stream", "slice"], "left").withColumn("p", F.coalesce("p", "handed")).drop("handed", "slice")


def _intervals(rows: DataFrame, request: Series, smaller: Column, extrema: Column, delta: dict[str, Column], empty: Column, unknown: Column | None = None) -> DataFrame:
    """One row per snapshot, which knows the one before (``p``), with its interval (begin, t) and, where it contradicts that, a code.

    ``unknown``: a first snapshot of which nobody knows what came before is only the base of the next."""
    has, ps, pt = F.col("p.t").isNotNull(), F.col("p.s"), F.col("p.t")
    reset = ~has | (F.col("s") > ps)
    code = (
        F.when(has & (F.col("t") == pt), F.lit("ambiguous_order"))
        .when(has & ((F.col("s") < ps) | ((F.col("s") > ps) & (F.col("s") < pt))), F.lit("ambiguous_reset"))
        .when(has & (F.col("s") == ps) & smaller, F.lit("unproven_reset"))
        .when(has & (F.col("s") == ps) & extrema, F.lit("invalid_extrema"))
    )
    rows = rows.withColumns({"reset": reset, "begin": F.when(reset, F.col("s")).otherwise(pt), "code": F.coalesce(F.col("code"), code)})
    rows = rows.withColumns({k: F.when(F.col("reset"), F.col(k)).otherwise(v) for k, v in delta.items()})
    base = ~has & (F.col("s") < request.start if unknown is None else (F.col("s") < request.start) | unknown)
    length = F.col("t") - F.col("begin")
    rows = rows.withColumns({"base": base, "length": length, "code": F.coalesce("code", F.when(~base & (length == 0) & ~empty, F.lit("zero_duration")))})
    rows = rows.withColumn("used", ~F.col("base") & (F.col("length") > 0))
    if b := request.bucket_nanos:
        bucket = (F.col("t") - 1) - F.pmod(F.col("t") - 1, F.lit(b))
        rows = rows.withColumn("bucket_start_nanos", bucket)
        rows = rows.withColumn("code", F.coalesce("code", F.when(F.col("used") & (F.col("begin") < F.col("bucket_start_nanos")), F.lit("crosses_bucket"))))
    return rows


def _ambiguous(rows: DataFrame, dims: list[str]) -> DataFrame:
    """(stream) of projections that hold more than one stream."""
    if dims:
        pairs = rows.select("stream", *dims).distinct()
        many = pairs.groupBy(*dims).agg(F.count("*").alias("n")).where("n > 1")
        return pairs.join(many, dims, "left_semi").select("stream")
    streams = rows.agg(F.min("stream").alias("lo"), F.max("stream").alias("hi")).where("lo != hi")
    return rows.select("stream").distinct().join(F.broadcast(streams.select(F.lit(1).alias("one"))), F.lit(True)).select("stream")


def violations(rows: DataFrame, dims: list[str], more: DataFrame | None = None) -> DataFrame:
    """(stream, code, t) of everything that contradicts the contract."""
    found = rows.where("code IS NOT NULL").select("stream", "code", "t")
    found = found.unionByName(_ambiguous(rows, dims).select("stream", F.lit("ambiguous_projection").alias("code"), F.lit(None).cast("long").alias("t")))
    return found.unionByName(more) if more is not None else found


def _settle(rows: DataFrame, found: DataFrame, strict: bool) -> DataFrame:
    """Strict: all rows, whose codes are checked when they have been summed. Else: streams without violations remain."""
    return rows if strict else rows.join(found.select("stream").distinct(), "stream", "left_anti")


def _groups(request: Series) -> list[str]:
    return ["bucket_start_nanos"] * (request.bucket_nanos is not None) + [d.replace("-", "_") for d in request.group_by]


def _rank(code: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, CODES)), code)


#: What a sum of rows keeps for the check: the first code, and whether streams meet.
CHECKS = {"_code": lambda: F.min(_rank(F.col("code"))), "_lo": lambda: F.min("stream"), "_hi": lambda: F.max("stream")}


def _checked(sums: DataFrame, dims: list[str], strict: bool) -> DataFrame:
    """Rows of ``sums`` that hold intervals. Strict: the first code raises; intervals are differenced once, and their sums, a row for each
    bucket and projection, are written for the check and the result, in files that go with the result."""
    if strict:
        sums = cut(sums)
        bounds = "bounds" in sums.columns
        per = sums.groupBy(*dims).agg(F.min("_code").alias("code"), F.min("_lo").alias("lo"), F.max("_hi").alias("hi"), *([F.min("bounds").alias("b_lo"), F.max("bounds").alias("b_hi")] if bounds else []))
        changed = F.when(F.col("b_lo") != F.col("b_hi"), _rank(F.lit("boundary_change"))) if bounds else F.lit(None).cast("bigint")
        many = F.when(F.col("lo") != F.col("hi"), _rank(F.lit("ambiguous_projection")))
        first = per.agg(F.min(F.least("code", many, changed)).alias("first")).first()["first"]
        if first is not None:
            raise TelemetryViolation(CODES[first - 1])
    return sums.where("interval_count > 0").drop(*CHECKS)


def _types(df: DataFrame, want: dict[str, str]) -> None:
    """Stored types that are not those of the table fail before any job."""
    have = dict(df.dtypes)
    if any(have.get(c) != t for c, t in want.items()):
        raise TelemetryViolation("type_drift")


def counter_snapshots(df: DataFrame, request: Series) -> DataFrame:
    """Snapshots of monotonic cumulative sums in the window, those outside their domain with a code."""
    _types(df, {"Value": "double", "AggregationTemporality": "int", "IsMonotonic": "boolean"})
    rows = _rows(df.where("IsMonotonic"), request, COUNTER_KEY)
    bad = (F.col("s") > F.col("t")) | ~finite(F.col("Value")) | (F.col("Value") < 0)
    return rows.withColumn("code", F.when(bad, F.lit("invalid_row")))


def counter_differences(rows: DataFrame, request: Series, unknown: Column | None = None) -> DataFrame:
    """Intervals of counter snapshots that know the one before."""
    return _intervals(rows, request, F.col("Value") < F.col("p.Value"), F.lit(False), {"Value": F.col("Value") - F.col("p.Value")}, F.col("Value") == 0, unknown)


def counter_intervals(df: DataFrame, request: Series, slice_nanos: int | None = SLICE) -> DataFrame:
    return counter_differences(_before(counter_snapshots(df, request), request, COUNTER_STATE, slice_nanos), request)


def counter_series(df: DataFrame, request: Series, strict: bool = True, slice_nanos: int | None = SLICE) -> DataFrame:
    """Increase and rate of cumulative monotonic sums, with interval and reset counts."""
    return counter_sums(counter_intervals(df, request, slice_nanos), request, strict)


def counter_sums(rows: DataFrame, request: Series, strict: bool = True) -> DataFrame:
    """Intervals, just made or stored by a stream, as increase and rate."""
    dims = [d.replace("-", "_") for d in request.group_by]
    rows = rows if strict else _settle(rows, violations(rows, dims), strict)
    groups = _groups(request)
    used = lambda c: F.sum(F.when(F.col("used"), F.col(c)))
    seconds = used("length").cast("double") / NANOS
    sums = rows.groupBy(*groups).agg(
        *[{"increase": used("Value"), "rate": used("Value") / seconds}[a].alias(a) for a in request.aggregates],
        F.count_if("used").alias("interval_count"), F.count_if(F.col("used") & F.col("reset")).alias("reset_count"), used("length").alias("observed_duration_nanos"), *[c().alias(n) for n, c in CHECKS.items()],
    )
    out = _checked(sums, dims, strict)
    return out.orderBy(*groups).limit(request.limit) if groups and request.limit is not None else out


def _zip(op, a: Column, b: Column) -> Column:
    return F.zip_with(a, b, op)


def histogram_snapshots(df: DataFrame, request: Series) -> DataFrame:
    """Snapshots of cumulative histograms in the window, those outside their domain with a code."""
    _types(df, {"Count": "decimal(20,0)", "Sum": "double", "BucketCounts": "array<decimal(20,0)>", "ExplicitBounds": "array<double>", "Min": "double", "Max": "double"})
    rows = _rows(df, request, HISTOGRAM_KEY)
    bounds, buckets, count = F.col("ExplicitBounds"), F.col("BucketCounts"), F.col("Count")
    total = F.aggregate(buckets, F.lit(0).cast(DEC), lambda acc, x: (acc + x).cast(DEC))
    rising = F.forall(F.sequence(F.lit(1), F.size(bounds)), lambda i: (i == 1) | (F.get(bounds, i - 1) > F.get(bounds, i - 2))) | (F.size(bounds) == 0)
    good = (
        (F.col("s") <= F.col("t")) & (F.col("Flags") == 0) & (F.size(buckets) == F.size(bounds) + 1) & F.forall(bounds, finite) & rising
        & F.forall(buckets, lambda x: x >= 0) & (total == count) & finite(F.col("Sum")) & ((count == 0) | (F.col("Min") <= F.col("Max"))) & ((count > 0) | (F.col("Sum") == 0))
    )
    return rows.withColumns({"code": F.when(~F.coalesce(good, F.lit(False)), F.lit("invalid_row")), "bounds": bounds})


def histogram_differences(rows: DataFrame, request: Series, unknown: Column | None = None) -> DataFrame:
    """Intervals of histogram snapshots that know the one before."""
    buckets, count = F.col("BucketCounts"), F.col("Count")
    smaller = (count < F.col("p.Count")) | F.exists(_zip(lambda a, b: a < b, buckets, F.col("p.BucketCounts")), lambda x: F.coalesce(x, F.lit(False)))
    inward = (count > 0) & (F.col("p.Count") > 0) & ((F.col("Min") > F.col("p.Min")) | (F.col("Max") < F.col("p.Max")))
    delta = {"BucketCounts": _zip(lambda a, b: (a - b).cast("decimal(20,0)"), buckets, F.col("p.BucketCounts")), "Sum": F.col("Sum") - F.col("p.Sum"), "Count": (count - F.col("p.Count")).cast("decimal(20,0)")}
    return _intervals(rows, request, smaller, inward, delta, F.col("Count") == 0, unknown)


def histogram_intervals(df: DataFrame, request: Series, slice_nanos: int | None = SLICE) -> DataFrame:
    return histogram_differences(_before(histogram_snapshots(df, request), request, HISTOGRAM_STATE, slice_nanos), request)


def bounded_quantile(buckets: Column, bounds: Column, total: Column, num: int, den: int) -> Column:
    """A struct: rank numerator over ``den``, the bucket it falls in, its count, an estimate by even spread and its greatest error.

    Ranks are whole numbers in DECIMAL(38,0); a bucket open to infinity gives no estimate.
    """
    sums = F.transform(F.sequence(F.lit(1), F.size(buckets)), lambda i: F.aggregate(F.slice(buckets, 1, i), F.lit(0).cast(DEC), lambda acc, x: (acc + x).cast(DEC)))

    def of(cum: Column) -> Column:
        at = F.array_position(F.transform(cum, lambda c: (c * den).cast(DEC) >= (total * num).cast(DEC)), True).cast("int")
        low, high, inside = F.get(bounds, at - 2), F.get(bounds, at - 1), F.get(buckets, at - 1).cast("double")
        below = F.when(at > 1, F.get(cum, at - 2)).otherwise(F.lit(0).cast(DEC))
        share = ((total * num).cast("double") / den - below.cast("double")) / inside
        estimate = F.when(low.isNotNull() & high.isNotNull(), low + (high - low) * share)
        return F.struct(
            (total * num).cast(DEC).alias("rank_numerator"), F.lit(den).alias("rank_denominator"), low.alias("lower"), high.alias("upper"), F.get(buckets, at - 1).cast(DEC).alias("in_bucket"),
            estimate.alias("estimate"), F.greatest(estimate - low, high - estimate).alias("max_error"),
        )

    return F.when(total > 0, F.element_at(F.transform(F.array(sums), of), 1))


QUANTILES = {"p50": (1, 2), "p95": (19, 20), "p99": (99, 100)}


def histogram_series(df: DataFrame, request: Series, strict: bool = True, slice_nanos: int | None = SLICE) -> DataFrame:
    """Histograms of what happened between snapshots, merged by bucket and dimensions."""
    return histogram_sums(histogram_intervals(df, request, slice_nanos), request, strict)


def histogram_sums(rows: DataFrame, request: Series, strict: bool = True) -> DataFrame:
    """Intervals, just made or stored by a stream, as merged histograms."""
    dims = [d.replace("-", "_") for d in request.group_by]
    if not strict:
        changed = rows.groupBy("stream").agg(F.min("bounds").alias("lo"), F.max("bounds").alias("hi")).where("lo != hi").select("stream", F.lit("boundary_change").alias("code"), F.lit(None).cast("long").alias("t"))
        rows = _settle(rows, violations(rows, dims, changed), strict)
    groups = _groups(request)
    keys = [*groups, "bounds"]
    # Buckets are summed by position before they are listed, so partial sums work; what is no bucket is summed at the first position.
    cells = rows.select(*keys, "used", "reset", "code", "stream", "Count", "Sum", "length", F.posexplode_outer("BucketCounts").alias("pos", "c"))
    used, once = F.col("used"), F.col("used") & (F.coalesce("pos", F.lit(0)) == 0)
    total = lambda c, when: F.sum(F.when(when, F.col(c)))
    cells = cells.groupBy(*keys, "pos").agg(
        total("c", used).cast(DEC).alias("c"), total("Count", once).cast(DEC).alias("count"), total("Sum", once).alias("sum"), F.count_if(once).alias("interval_count"),
        F.count_if(once & F.col("reset")).alias("reset_count"), total("length", once).alias("observed_duration_nanos"), *[c().alias(n) for n, c in CHECKS.items()],
    )
    counts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda x: x["c"])
    sums = cells.groupBy(*keys).agg(
        counts.alias("bucket_counts"), *[F.sum(c).alias(c) for c in ("count", "sum", "interval_count", "reset_count", "observed_duration_nanos")],
        F.min("_code").alias("_code"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
    )
    joined = _checked(sums, dims, strict).withColumn("count", F.col("count").cast(DEC))
    measure = {"count": F.col("count"), "sum": F.col("sum"), "avg": F.when(F.col("count") > 0, F.col("sum") / F.col("count").cast("double"))}
    measure |= {q: bounded_quantile(F.col("bucket_counts"), F.col("bounds"), F.col("count"), *QUANTILES[q]) for q in QUANTILES}
    out = joined.select(*groups, *[measure[a].alias(a) for a in request.aggregates], F.col("bounds").alias("explicit_bounds"), "interval_count", "reset_count", "observed_duration_nanos")
    return out.orderBy(*groups).limit(request.limit) if groups and request.limit is not None else out
