"""Closed requests: everything is checked before any job starts; errors carry structure only, never telemetry values."""

from __future__ import annotations

from dataclasses import dataclass, field

# The published vocabularies.
BUCKETS = {"none": None, "1m": 60 * 10**9, "5m": 300 * 10**9, "15m": 900 * 10**9, "1h": 3600 * 10**9}
TOP_FIELDS = {
    "spans": ["service-name", "span-name", "span-kind", "status-code", "scope-name", "trace-id", "deployment-environment", "http-request-method"],
    "logs": ["service-name", "severity-text", "event-name", "scope-name", "trace-id"],
    "metrics": ["service-name", "metric-name", "metric-unit", "scope-name", "deployment-environment"],
}
DIMENSIONS = ["service-name", "scope-name", "metric-unit", "deployment-environment"]
AGGREGATES = {
    "gauge": ["count", "sum", "min", "max", "avg", "p50", "p95", "p99"],
    "sum": ["count", "sum", "min", "max", "avg", "p50", "p95", "p99"],
    "histogram": ["count", "sum", "avg"],
    "cumulative-counter": ["increase", "rate"],
    "cumulative-histogram": ["count", "sum", "avg", "p50", "p95", "p99"],
    "typed-int64": ["count", "min", "max", "avg"],
}
OPERATORS = {"string": ["eq", "starts-with", "contains"], "boolean": ["eq"], "int64": ["eq", "gte", "lt"]}
MAX_INT64 = (1 << 63) - 1


class InvalidRequest(ValueError):
    def __init__(self, code: str, **evidence: object):
        super().__init__(code + "".join(f" {k}={v}" for k, v in evidence.items()))
        self.code, self.evidence = code, evidence


@dataclass(frozen=True)
class Limits:
    max_window_nanos: int = 24 * 3600 * 10**9
    max_rows: int = 100
    max_text: int = 256
    max_fields: int = 8


def _int(x: object) -> bool:
    return isinstance(x, int) and not isinstance(x, bool)


def check_window(start: int, end: int, limits: Limits) -> None:
    if not (_int(start) and _int(end) and 0 <= start <= MAX_INT64 and 0 <= end <= MAX_INT64):
        raise InvalidRequest("invalid_time")
    if start >= end or end - start > limits.max_window_nanos:
        raise InvalidRequest("invalid_window", maximum=limits.max_window_nanos)


def check_list(name: str, values: object, allowed: list[str], most: int, least: int = 0) -> None:
    if not isinstance(values, (list, tuple)) or not least <= len(values) <= most or len(set(values)) != len(values) or any(v not in allowed for v in values):
        raise InvalidRequest(f"invalid_{name}", maximum=most)


def check_range(name: str, value: object, low: int, high: int) -> None:
    if not _int(value) or not low <= value <= high:
        raise InvalidRequest(f"invalid_{name}", minimum=low, maximum=high)


@dataclass(frozen=True)
class TopValues:
    signal: str
    fields: list[str]
    start: int
    end: int
    limit: int = 10
    max_text_length: int = 128
    limits: Limits = field(default_factory=Limits)

    def __post_init__(self):
        if self.signal not in TOP_FIELDS:
            raise InvalidRequest("invalid_signal")
        check_window(self.start, self.end, self.limits)
        check_list("fields", self.fields, TOP_FIELDS[self.signal], self.limits.max_fields, 1)
        check_range("limit", self.limit, 1, self.limits.max_rows)
        check_range("max_text_length", self.max_text_length, 1, self.limits.max_text)


@dataclass(frozen=True)
class Series:
    """One request for metric series, counters and cumulative histograms; ``kind`` names its aggregates."""

    kind: str
    metric_name: str
    start: int
    end: int
    aggregates: list[str]
    group_by: list[str] = field(default_factory=list)
    bucket: str = "none"
    limit: int | None = 100
    max_text_length: int = 128
    temporality: str | None = None
    monotonic: bool | None = None
    limits: Limits = field(default_factory=Limits)

    def __post_init__(self):
        if self.kind not in AGGREGATES or self.kind == "typed-int64":
            raise InvalidRequest("invalid_kind")
        if self.kind == "cumulative-counter" and not (self.temporality == "cumulative" and self.monotonic is True):
            raise InvalidRequest("missing_provenance")
        if self.kind == "cumulative-histogram" and self.temporality != "cumulative":
            raise InvalidRequest("missing_provenance")
        check_window(self.start, self.end, self.limits)
        if not isinstance(self.metric_name, str) or not self.metric_name.strip() or len(self.metric_name) > self.limits.max_text:
            raise InvalidRequest("invalid_metric_name", maximum=self.limits.max_text)
        check_list("group_by", self.group_by, DIMENSIONS, self.limits.max_fields)
        check_list("aggregates", self.aggregates, AGGREGATES[self.kind], len(AGGREGATES[self.kind]), 1)
        if self.bucket not in BUCKETS:
            raise InvalidRequest("invalid_bucket")
        if self.limit is not None:  # None: all rows, in no order
            check_range("limit", self.limit, 1, self.limits.max_rows)
        check_range("max_text_length", self.max_text_length, 1, self.limits.max_text)

    @property
    def bucket_nanos(self) -> int | None:
        return BUCKETS[self.bucket]


def check_predicate(kind: str, operator: str, value: object) -> None:
    if operator not in OPERATORS.get(kind, ()):
        raise InvalidRequest("invalid_operator")
    fits = {"string": isinstance(value, str), "boolean": isinstance(value, bool), "int64": _int(value) and -MAX_INT64 - 1 <= value <= MAX_INT64}[kind]
    if not fits or (value == "" and operator != "eq"):
        raise InvalidRequest("invalid_value")
