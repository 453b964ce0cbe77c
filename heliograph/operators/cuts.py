"""Results that are written once and read from there, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session (tests) may go without and gets a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not (sc.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there; Spark's cleaner removes the files once the result is gone."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
