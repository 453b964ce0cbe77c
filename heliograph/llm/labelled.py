"""Bounded, reproducible training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import bucket_of


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int) -> DataFrame:
    """(doc_id, text, label) in one partition: one text of each of at most ``per_class`` labelled ids of each class outside the held-out remainder.

    The ids come first by a hash, so every run picks the same. The id list has at most 2 * per_class rows (a
    repeated label row counts once), which bounds the broadcast; of an id with several texts the first by a hash
    stands for all, so a frequent id is no more than a row. The documents are read and filtered by all tasks; an
    exchange then brings the sample, and nothing else, to the one that trains. The texts never pass the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (bucket_of(F.col("doc_id"), modulus) != held_out))
    # An id labelled both ways teaches nothing.
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    one = lambda y: known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    found = rows.join(F.broadcast(one(0).unionByName(one(1))), "doc_id")
    first = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return first.select("doc_id", F.col("t.text").alias("text"), "label").repartition(1)


def class_counts(labels: DataFrame, label: str, modulus: int, held_out: int) -> tuple[int, int]:
    """How many training labels are 0 and 1, over the whole table."""
    known = labels.where(bucket_of(F.col("doc_id"), modulus) != held_out)
    row = known.agg(*[F.count(F.when(F.col(label) == y, 1)).alias(f"n{y}") for y in (0, 1)]).first()
    return row["n0"], row["n1"]
