"""Cumulative counters and histograms differenced as they come, with the last snapshot of each stream as state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from ..operators import cumulative
from ..operators.scan import NANOS
from ..plans.requests import Series

KEY = ["stream_x", "stream_y"]
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Before(StatefulProcessor):
    """Hands each row of a stream the snapshot before it.

    A batch's rows are taken in order of time. Rows that are not after the stream's last snapshot of an earlier batch come
    out marked, without a snapshot before, and leave the state as it is: one at the very time of the last snapshot knows
    that snapshot, so that its order is found to be ambiguous, an older one is late.
    """

    def __init__(self, names: list[str], state: T.StructType, expiry_ms: int | None):
        self.names, self.state, self.expiry_ms = names, state, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.state, self.expiry_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True).sort_values("t", kind="stable")
        last = self.last.get() if self.last.exists() else None
        old = frame["t"] <= last[0] if last is not None else pd.Series(False, frame.index)
        news, olds = frame[~old].copy(), frame[old].copy()
        for i, n in enumerate(self.names):
            first = None if last is None else last[i]
            news[f"p_{n}"] = pd.Series([first, *news[n].tolist()[:-1]], news.index, dtype=object) if len(news) else None
            olds[f"p_{n}"] = pd.Series([first if t == last[0] else None for t in olds["t"]], olds.index, dtype=object) if len(olds) else None
        news["late"], olds["late"] = False, olds["t"] < last[0] if last is not None else False
        if len(news):
            values = [news[n].iloc[-1] for n in self.names]
            self.last.update(tuple(v.tolist() if isinstance(v, np.ndarray | np.generic) else v for v in values))
        parts = [p for p in (olds, news) if len(p)]
        yield pd.concat(parts)[[*frame.columns, *[f"p_{n}" for n in self.names], "late"]]

    def close(self) -> None:
        pass


def with_before(rows: DataFrame, state: list[str], expiry_ms: int | None = None) -> DataFrame:
    """A stream of snapshots (``stream``, t, s and ``state``) with ``p``, the one before each, and ``late``.

    A stream's snapshots of one micro-batch are in one task; bound micro-batches at the source. ``expiry_ms``: a stream
    that is idle for so long is forgotten.
    """
    flat = rows.withColumns({KEY[0]: F.col("stream.x"), KEY[1]: F.col("stream.y")}).drop("stream", *cumulative.MAPS)
    names = ["t", "s", *state]
    kinds = {f.name: f.dataType for f in flat.schema}
    kept = T.StructType([T.StructField(n, kinds[n]) for n in names])
    out = T.StructType([*flat.schema.fields, *[T.StructField(f"p_{n}", kinds[n]) for n in names], T.StructField("late", T.BooleanType())])
    # The operator keeps its state in RocksDB only.
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    known = flat.groupBy(*KEY).transformWithStateInPandas(Before(names, kept, expiry_ms), out, "Append", "None" if expiry_ms is None else "ProcessingTime")
    before = F.when(F.col("p_t").isNotNull(), F.struct(*[F.col(f"p_{n}").alias(n) for n in names]))
    return known.withColumns({"stream": F.struct(F.col(KEY[0]).alias("x"), F.col(KEY[1]).alias("y")), "p": before}).drop(*KEY, *[f"p_{n}" for n in names])


def _differences(rows: DataFrame, request: Series, state: list[str], judge: Callable[..., DataFrame], expiry_ms: int | None) -> DataFrame:
    known = with_before(rows, state, expiry_ms)
    late = known.withColumn("code", F.coalesce("code", F.when(F.col("late"), F.lit("late_row"))))
    # A stream that may have been forgotten starts again from a base: nothing is counted twice.
    old = F.lit(False) if expiry_ms is None else F.col("t") - F.col("s") > expiry_ms * (NANOS // 1000)
    out = judge(late, request, unknown=old | F.col("late"))
    return out.withColumn("used", F.col("used") & ~F.col("late")).drop("late")


def counter_intervals(sums: DataFrame, request: Series, expiry_ms: int | None = None) -> DataFrame:
    """A stream of rows of the sum table as a stream of intervals: what ``cumulative.counter_intervals`` gives for all of them at once.

    Rows older than their stream's last snapshot come out with the code ``late_row`` and no interval; nothing is left out.
    """
    return _differences(cumulative.counter_snapshots(sums, request), request, cumulative.COUNTER_STATE, cumulative.counter_differences, expiry_ms)


def histogram_intervals(histograms: DataFrame, request: Series, expiry_ms: int | None = None) -> DataFrame:
    """A stream of rows of the histogram table as a stream of intervals."""
    return _differences(cumulative.histogram_snapshots(histograms, request), request, cumulative.HISTOGRAM_STATE, cumulative.histogram_differences, expiry_ms)


#: Columns that summing intervals reads; dimensions and buckets come with the request.
COUNTER_INTERVAL = ["stream", "t", "s", "begin", "length", "Value", "reset", "used", "code"]
HISTOGRAM_INTERVAL = ["stream", "t", "s", "begin", "length", "BucketCounts", "Count", "Sum", "bounds", "reset", "used", "code"]


def store_intervals(intervals: DataFrame, request: Series, path: str, checkpoint: str) -> DataStreamWriter:
    """Write a stream of intervals to ``path``, for ``cumulative.counter_sums`` and ``histogram_sums`` to read.

    The file sink's own log makes each micro-batch visible as a whole and once.
    """
    columns = HISTOGRAM_INTERVAL if "BucketCounts" in intervals.columns else COUNTER_INTERVAL
    groups = ["bucket_start_nanos"] * (request.bucket_nanos is not None) + [d.replace("-", "_") for d in request.group_by]
    return intervals.select(*columns, *groups).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
