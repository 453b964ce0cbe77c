"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
MASK64 = (1 << 64) - 1
#: Rows of an Arrow batch, so that long texts do not fill a Python worker. One number for all operators: the setting is the session's.
BATCH_ROWS = 500
#: Tables of up to this many rows are broadcast (as long as a row stays within some hundred bytes), larger ones are joined by shuffle.
SMALL_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session (tests) may go without and gets a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not (sc.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_batches(df: DataFrame) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if its rows, counted first, are few; else as it is, for Spark to join by shuffle. ``df`` should be cheap to count."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def fresh(name: str, columns: Iterable[str]) -> str:
    """``name``, lengthened until no column has it (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    name = f"_{name}"
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """The labelled split: crc32 of the id as text, modulo ``modulus``; null ids are never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes add up to about ``limit``; a larger row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
