"""Operator 4: repeated passages by content-defined chunking with a gear rolling hash.

The gear hash of a byte position sums table entries of the last bytes, each
shifted by its age. A text is cut behind the least hash of every window of
WINDOW positions, so cuts depend on nearby bytes alone, an insertion shifts no
later cut, and no chunk inside ordinary text exceeds WINDOW bytes. Chunks are
deduplicated by digest: a digest found under two document ids is repeated.
Neighbouring repeated chunks of a document join to a run; a run counts when its
whole chunks hold ``min_words`` words. A run is cut into passages where the first
document (the least id that holds a chunk) changes, so a passage lies in its first
document as a whole, and taking it out of the others leaves it somewhere. A cut
lies at most GEAR + WINDOW bytes inside either end of a shared passage, so a shared
passage of more than 50 words keeps some 35 words on average in whole chunks.

Digests have 64 bits; a chance collision makes one chunk repeated and no run.

Defined results: null and empty texts have no chunks and no rows; a null doc_id
is a document of its own (all rows with null ids count as one), the least of all;
rows repeated with the same id are one document, equal rows give one set of
passages; a chunk twice in one document alone is not repeated; texts of any length
are read whole; columns besides doc_id and text may have any name: passages do not
carry them, ``drop_repeats`` carries all; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import fresh, slices, small_batches, table

GEAR, WINDOW, LEAST, MOST = 16, 80, 16, 160
#: A shorter chunk is digested with the bytes before it: a few letters alone recur by chance.
SHORT = 32
#: A fixed table from a fixed seed: 256 numbers of 32 bits.
TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 32, 256, dtype=np.uint32)
NO_ID = -(1 << 63)


def cuts(data: bytes) -> np.ndarray:
    """Ends of all chunks of one text, the text's own end included."""
    return chunk_ends([data])[0]


def chunk_ends(texts: list[bytes]) -> list[np.ndarray]:
    gap = WINDOW
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.concatenate(([gap], sizes[:-1] + gap))) if len(texts) else np.zeros(0, np.int64)
    flat = np.frombuffer((b"\0" * gap).join([b"", *texts, b""]), np.uint8)
    h = TABLE[flat]
    step = 1
    while step < GEAR:
        older = h[:-step] << np.uint32(step)
        h[step:] += older
        step *= 2
    inside = np.zeros(len(flat) + 1, np.int32)
    np.add.at(inside, np.minimum(starts + GEAR - 1, starts + sizes), 1)
    np.add.at(inside, starts + sizes, -1)
    key = (h.astype(np.uint64) << np.uint64(31)) | np.arange(len(flat), dtype=np.uint64)
    key[np.cumsum(inside[:-1]) == 0] = np.uint64((1 << 63) - 1)
    least, width = key, 1
    while width < WINDOW:  # least[i] covers i - width + 1 .. i
        by = min(width, WINDOW - width)
        wider = least.copy()
        np.minimum(least[by:], least[:-by], out=wider[by:])
        least, width = wider, width + by
    picked = least[np.concatenate(([True], least[1:] != least[:-1]))]
    picked = picked[picked != np.uint64((1 << 63) - 1)]
    at = (picked & np.uint64((1 << 31) - 1)).astype(np.int64)
    value = picked >> np.uint64(31)
    order = np.argsort(at, kind="stable")
    at, value = at[order], value[order]
    fresh = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.zeros(0, bool)
    at, value = at[fresh], value[fresh]
    if len(at):  # runs of equal bytes have equal hashes everywhere: keep the first of them
        run = np.concatenate(([False], (value[1:] == value[:-1]) & (np.diff(at) < LEAST)))
        at = at[~run]
    ends = at + 1
    for _ in range(3):  # not inside a character
        low = flat[np.minimum(ends, len(flat) - 1)]
        ends = ends + ((low & 0xC0) == 0x80)
    out = []
    bounds = np.searchsorted(ends, np.stack([starts + 1, starts + sizes])) if len(texts) else np.zeros((2, 0), int)
    for i, (lo, hi) in enumerate(bounds.T.tolist()):
        own = np.append(ends[lo:hi] - starts[i], sizes[i]) if sizes[i] else np.zeros(0, np.int64)
        long = np.flatnonzero(np.diff(own, prepend=0) > MOST)
        if len(long):  # only in text that repeats a few bytes over and over: cut it evenly from its last cut on
            edges = np.concatenate(([0], own))
            own = np.unique(np.concatenate([own, *[np.arange(edges[k] + MOST, own[k], MOST) for k in long]]))
            raw = np.frombuffer(texts[i], np.uint8)
            for _ in range(3):
                own = own + ((raw[np.minimum(own, len(raw) - 1)] & 0xC0) == 0x80) * (own < len(raw))
            own = np.unique(own)
        out.append(own)
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row_key", "doc_id", "idx", "start", "end", "words_before", "words_after", "digest"]
    for b in batches:
        ids, row_keys, texts = b.column("doc_id").to_pylist(), b.column("row_key").to_pylist(), [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
        for lo, hi in slices([len(t) for t in texts], 2_000_000):
            cols: list[list[np.ndarray]] = [[] for _ in names]
            for i, row_key, text, ends in zip(ids[lo:hi], row_keys[lo:hi], texts[lo:hi], chunk_ends(texts[lo:hi])):
                if not len(ends):
                    continue
                raw = np.frombuffer(text, np.uint8)
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
                word = np.concatenate(([0], np.cumsum(~blank & np.concatenate(([True], blank[:-1])))))
                begin = np.concatenate(([0], ends[:-1]))
                digests = [xxhash.xxh3_64_intdigest(text[max(0, min(x, y - SHORT)) : y]) for x, y in zip(begin.tolist(), ends.tolist())]
                n, doc = len(ends), NO_ID if i is None else i
                values = (np.full(n, row_key, np.int64), np.full(n, doc, np.int64), np.arange(n, dtype=np.int32), chars[begin].astype(np.int32), chars[ends].astype(np.int32), word[begin].astype(np.int32), word[ends].astype(np.int32), np.array(digests, np.uint64).view(np.int64))
                for c, v in zip(cols, values):
                    c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names)


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def chunks(docs: DataFrame) -> DataFrame:
    """One row for each chunk of each text; the same text gives the same chunks wherever it is cut."""
    schema = "row_key long, doc_id long, idx int, start int, end int, words_before int, words_after int, digest long"
    return small_batches(docs.select(_row_key().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(_chunks, schema)


def passages(docs: DataFrame, min_words: int = 18) -> DataFrame:
    """row_key, doc_id, start, end (code points), n_words, first_doc_id, copies and run_words of each passage.

    Digests are counted with partial sums, so a passage of every document is no hot group; the join back is a
    sort-merge join, whose skewed partitions Spark splits. A window holds the repeated chunks of one text.
    """
    parts = chunks(docs)
    shared = parts.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"), F.count("*").alias("copies"))
    shared = shared.where("first_doc_id < last").drop("last")
    hits = parts.join(shared, "digest").drop("digest")
    # Equal rows give a chunk twice: dense ranks count it once.
    run = F.col("idx") - F.dense_rank().over(Window.partitionBy("row_key").orderBy("idx"))
    part = F.col("idx") - F.dense_rank().over(Window.partitionBy("row_key", "first_doc_id").orderBy("idx"))
    whole = Window.partitionBy("row_key", "run")
    hits = hits.withColumn("run", run).withColumn("part", part)
    hits = hits.withColumn("run_words", F.max("words_after").over(whole) - F.min("words_before").over(whole)).where(F.col("run_words") >= min_words)
    found = hits.groupBy("row_key", "doc_id", "run", "part", "first_doc_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("words_after") - F.min("words_before")).alias("n_words"), F.max("copies").alias("copies"), F.first("run_words").alias("run_words")
    )
    no = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return found.select("row_key", no("doc_id"), "start", "end", "n_words", no("first_doc_id"), "copies", "run_words")


def repeated_passages(docs: DataFrame, min_words: int = 18) -> DataFrame:
    """The passages, with ``dropped``: whether ``drop_repeats`` takes the passage out, as another document is its first."""
    return passages(docs, min_words).drop("row_key").withColumn("dropped", ~F.col("doc_id").eqNullSafe(F.col("first_doc_id")))


def drop_repeats(docs: DataFrame, min_words: int = 18) -> DataFrame:
    """``docs`` with each repeated passage left only in its first document; all rows and columns stay."""
    key, cuts = fresh("row_key", docs.columns), fresh("cuts", docs.columns)
    gone = passages(docs, min_words).where(~F.col("doc_id").eqNullSafe(F.col("first_doc_id")))
    gone = gone.groupBy(F.col("row_key").alias(key)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cuts))
    joined = docs.withColumn(key, _row_key()).join(gone, key, "left")
    ends, starts = F.concat(F.array(F.lit(0)), F.col(cuts)["end"]), F.concat(F.col(cuts)["start"], F.array(F.length("text")))
    kept = F.array_join(F.zip_with(ends, starts, lambda e, s: F.substr(F.col("text"), e + 1, s - e)), "")
    return joined.withColumn("text", F.when(F.col(cuts).isNull(), F.col("text")).otherwise(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
