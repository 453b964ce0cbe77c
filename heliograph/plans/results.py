"""Declared shapes of results: columns, types and ranges of what each operator returns, checked before a caller sees a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .requests import Series, TopValues

NUMBER = {"count": "count", "sum": "double", "min": "double", "max": "double", "avg": "double", "increase": "double", "rate": "double", "p50": "double", "p95": "double", "p99": "double"}
QUANTILE = "struct<rank_numerator:decimal(38,0),rank_denominator:int,lower:double,upper:double,in_bucket:decimal(38,0),estimate:double,max_error:double>"
INTERVALS = {"interval_count": "bigint", "reset_count": "bigint", "observed_duration_nanos": "bigint"}
COVERAGE = {c: "bigint" for c in ("total", "valid", "present_empty", "absent", "invalid", "fallback", "unavailable", "unknown_status")}
VALUES = {"attribute_key": "string", "location": "string", "value": "string", "typed_status": "int", "source": "string", "count": "bigint"}


class ResultMismatch(ValueError):
    """A result whose columns or types are not the declared ones; ``columns`` names them."""

    def __init__(self, columns: list[str]):
        super().__init__("invalid_result_shape " + ", ".join(columns))
        self.code, self.columns = "invalid_result_shape", columns


def top_values_shape(request: TopValues) -> dict[str, str]:
    return {"signal": "string", "field": "string", "value": "string", "count": "bigint"}


def series_shape(request: Series) -> dict[str, str]:
    """Columns of a metric series, a counter or a cumulative histogram, in the order they come."""
    shape = {"bucket_start_nanos": "bigint"} if request.bucket_nanos is not None else {}
    shape |= {d.replace("-", "_"): "string" for d in request.group_by}
    if request.kind == "cumulative-histogram":
        kinds = {"count": "decimal(38,0)", "sum": "double", "avg": "double", "p50": QUANTILE, "p95": QUANTILE, "p99": QUANTILE}
        return shape | {a: kinds[a] for a in request.aggregates} | {"explicit_bounds": "array<double>"} | INTERVALS
    count = "decimal(38,0)" if request.kind == "histogram" else "bigint"
    shape |= {a: count if a == "count" else NUMBER[a] for a in request.aggregates}
    return shape | (INTERVALS if request.kind == "cumulative-counter" else {})


def _domain(name: str, kind: str) -> Column | None:
    """What a value of a declared column must be: counts are there and not negative, numbers finite where they are there, texts there."""
    c = F.col(f"`{name}`")
    if name in ("count", "bucket_start_nanos", *INTERVALS, *COVERAGE):
        return c.isNotNull() & (c >= 0)
    if kind == "double":
        return c.isNull() | (~F.isnan(c) & (F.abs(c) < float("inf")))
    return c.isNotNull() if kind == "string" else None


def shaped(df: DataFrame, shape: dict[str, str], max_text: int | None = None) -> DataFrame:
    """``df`` if it has the declared columns and types, in their order; a value outside its domain fails the query that reads it.

    Errors name the column alone, never a value.
    """
    have = dict(df.dtypes)
    if odd := sorted({c for c, t in shape.items() if have.get(c) != t} | (have.keys() - shape.keys())):
        raise ResultMismatch(odd)
    checked = []
    for name, kind in shape.items():
        c, good = F.col(f"`{name}`"), _domain(name, kind)
        if kind == "string" and max_text is not None:
            good = good & (F.length(c) <= max_text)
        checked.append(c if good is None else F.when(good, c).otherwise(F.raise_error(F.lit(f"invalid_result {name}")).cast(kind)).alias(name))
    return df.select(*checked)
