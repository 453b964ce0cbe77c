"""Every telemetry query against its SQL on DuckDB."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from heliograph.plans import catalog

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 5)
    return int(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert name in catalog.ORACLES
    df = catalog.QUERIES[name](spark, DATA)
    rel = duck.sql(catalog.ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want


def test_typed_points_are_not_capped(spark, tmp_path):
    one = spark.read.parquet(f"{DATA}/events.parquet").limit(1)
    ts = F.lit("2024-01-15 12:00:00").cast(one.schema["ts"].dataType)
    many = one.withColumns({"ts": ts, "event_type": F.lit("purchase"), "props": F.lit('{"k": 5}')}).crossJoin(spark.range(100_500)).drop("id")
    many.write.parquet(f"{tmp_path}/events.parquet")
    assert catalog.QUERIES["d_20"](spark, str(tmp_path)).count() == 100_500
