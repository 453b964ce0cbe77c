"""Service dashboard, table reconciliation and log-span correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .cuts import cut
from .scan import canonical


def dashboard(spans: DataFrame, service: str | None = None, limit: int = 8, approximate: bool = True) -> DataFrame:
    """Count and 95th percentile of duration (ms) per span name, most frequent first. The percentile is sketched unless an exact one is asked for."""
    rows = spans if service is None else spans.where(F.col("ServiceName") == service)
    ms = F.col("Duration") / F.lit(1e6)
    return rows.groupBy("SpanName").agg(F.count("*").alias("n"), (F.percentile_approx(ms, 0.95) if approximate else F.percentile(ms, F.lit(0.95))).alias("p95_ms")).orderBy(F.desc("n"), "SpanName").limit(limit)


def _sorted(f: T.StructField) -> Column:
    """A column that can be compared: maps, also those in lists, as sorted entries."""
    if isinstance(f.dataType, T.MapType):
        return canonical(f.name)
    if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.MapType):
        return F.transform(f.name, lambda m: F.array_sort(F.map_entries(m)))
    return F.col(f.name)


def normal(df: DataFrame) -> DataFrame:
    """Maps as sorted entries, so that rows can be compared."""
    return df.select(*[_sorted(f).alias(f.name) for f in df.schema])


def row_text(df: DataFrame) -> Column:
    """All columns of a row as one text: maps as sorted k=v, nothing as null."""

    def one(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.MapType):
            c = F.array_join(F.transform(_sorted(f), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
        else:
            c = F.to_json(_sorted(f)) if isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast("string")
        return F.coalesce(c, F.lit("null"))

    return F.concat_ws("\x1f", *map(one, df.schema))


def digest(df: DataFrame, name: str) -> DataFrame:
    """(name, rows, digest): an order-free sum of a 60-bit hash of every row, over all columns."""
    h = F.conv(F.left(F.md5(row_text(df).cast("binary")), F.lit(15)), 16, 10).cast("decimal(38,0)")
    return df.select(h.alias("h")).agg(F.count("*").alias("rows"), F.coalesce(F.sum("h"), F.lit(0)).cast("string").alias("digest")).select(F.lit(name).alias("name"), "rows", "digest")


def difference(written: DataFrame, read: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, copies counted."""
    a, b = normal(written), normal(read)
    return a.exceptAll(b).withColumn("side", F.lit("written")).unionByName(b.exceptAll(a).withColumn("side", F.lit("read")))


#: Ranges of a day that the tree tells apart.
RANGES = 256


def digest_tree(df: DataFrame, day: Column, place: Column, ranges: int = RANGES) -> DataFrame:
    """(day, range, rows, x, y): digests of the rows of each day and range of places, each an order-free sum of 128-bit row hashes.

    ``place`` is a number that tells rows of a day apart, such as the time of day or a hash of the key; copies are counted.
    """
    h = F.md5(row_text(df).cast("binary"))
    half = lambda i: F.conv(F.substring(h, i, 15), 16, 10).cast("decimal(38,0)")
    marked = df.select(day.alias("day"), F.pmod(place, F.lit(ranges)).cast("int").alias("range"), half(1).alias("x"), half(17).alias("y"))
    return marked.groupBy("day", "range").agg(F.count("*").alias("rows"), F.sum("x").alias("x"), F.sum("y").alias("y"))


def unequal_ranges(written: DataFrame, read: DataFrame) -> DataFrame:
    """(day, range) of two trees that differ: first the days, then the ranges of those days."""
    top = lambda t: t.groupBy("day").agg(F.sum("rows").alias("rows"), F.sum("x").alias("x"), F.sum("y").alias("y"))

    def unequal(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        both = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1)))
        off = [F.sum(F.col(c) * F.col("side")) != 0 for c in ("rows", "x", "y")]
        return both.groupBy(*keys).agg((off[0] | off[1] | off[2]).alias("off")).where("off").select(*keys)

    days = unequal(top(written), top(read), ["day"])
    within = lambda t: t.join(F.broadcast(days), F.col("day").eqNullSafe(F.col("_day")), "left_semi")
    days = days.withColumnRenamed("day", "_day")
    return unequal(within(written), within(read), ["day", "range"])


def difference_by_tree(written: DataFrame, read: DataFrame, day: str, place: str, ranges: int = RANGES) -> DataFrame:
    """The rows of ``difference``; only those of ranges whose digests differ are moved.

    ``day`` and ``place`` are SQL expressions over the columns of both sides. A day with many ranges that differ is compared whole.
    """
    a, b = (cut(digest_tree(t, F.expr(day), F.expr(place), ranges)) for t in (written, read))
    # At most ``ranges`` rows a day, and only of days that differ.
    off = cut(unequal_ranges(a, b)).select(F.col("day").alias("_day"), F.col("range").alias("_range"))

    def within(t: DataFrame) -> DataFrame:
        return t.join(F.broadcast(off), F.expr(day).eqNullSafe(F.col("_day")) & F.pmod(F.expr(place), F.lit(ranges)).cast("int").eqNullSafe(F.col("_range")), "left_semi")

    return difference(within(written), within(read))


def correlate(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Logs with their span's name and service, where it is known. Rows without ids belong to no span; they do not meet in one key."""
    named = (F.coalesce("TraceId", F.lit("")) != "") & (F.coalesce("SpanId", F.lit("")) != "")
    s = spans.where(named).select("TraceId", "SpanId", "SpanName", F.col("ServiceName").alias("span_service"))
    joined = logs.where(named).join(s, ["TraceId", "SpanId"], "left")
    alone = logs.where(~named).withColumns({"SpanName": F.lit(None).cast("string"), "span_service": F.lit(None).cast("string")})
    return joined.unionByName(alone)
