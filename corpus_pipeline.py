"""A corpus pipeline: toxic documents go, near duplicates shrink to one, secrets are masked, sources are mixed, texts become pieces.

Each stage works on all rows its predecessor kept. Stage by stage, on the columns of ``documents``:
toxicity drops documents whose score reaches 0.5 (the field learns from ``labels`` beside the documents);
near_duplicates keeps one document of each class; secrets replaces each secret in the text by a mark and keeps
every document; mixing keeps the documents that the mix takes, one row for each copy; pieces adds a sampled
segmentation of the text to every row (``ids``, ``n_pieces``, ``lossless``).

Defined results: rows with null columns, null, empty or very long texts go through every stage; toxicity, secrets
and pieces keep a clean row as often as it comes; near_duplicates keeps all rows without words and one of equal rows;
mixing takes no row without words, and of rows alike in id, source and size each gets the same number of copies,
rounded up; ties are broken as the operators say; columns beyond those of ``documents`` are left out by each stage;
an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliograph.llm.common import cut, table
from heliograph.llm.mixing import mix, sized, source_targets
from heliograph.llm.near_duplicates import keep_one
from heliograph.llm.sampled_pieces import encode_pieces, row_key
from heliograph.llm.secret_scan import redact
from heliograph.llm.toxicity import tag_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tag_toxicity(docs.select(COLUMNS), table(spark, sf_dir, "labels")).where("predicted = 0").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs.select(COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redact(docs.select(COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    sizes = cut(sized(docs))
    taken = mix(sizes, source_targets(sizes)).where("taken > 0")
    copies = taken.groupBy("doc_id", "source", "size").agg(F.sum(F.col("taken") / F.col("size")).cast("long").alias("copies"), F.count("*").alias("rows"))
    keyed = docs.select(COLUMNS).withColumn("size", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long"))
    names = ["doc_id", "source", "size"]
    copies = copies.select(*[F.col(c).alias(f"_{c}") for c in names], F.ceil(F.col("copies") / F.col("rows")).cast("int").alias("_n"))
    same = [keyed[c].eqNullSafe(F.col(f"_{c}")) for c in names]
    joined = keyed.join(copies, same[0] & same[1] & same[2])
    return joined.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_pieces(docs.select(COLUMNS), row_key(F.col("doc_id")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("pieces", pieces),
]

# A trained field, an approximate search and a trained forest are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each cut to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
