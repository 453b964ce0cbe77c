"""Numbers as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def let(name: str, value: str, then: str) -> str:
    """SQL ``then``, in which ``name`` is a value that is computed once, however often it is used."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def bound(value: Column, name: str, then: str) -> Column:
    """``let`` of a column: one short expression, where building it of columns would take thousands of calls."""
    return F.element_at(F.call_function("transform", F.array(value), F.expr(f"{name} -> {then}")), 1)


def double_sql() -> str:
    """SQL of the text of a double ``d_``."""
    whole, rest = "substring_index(substring_index(t_, 'E', 1), '.', 1)", "substring_index(substring_index(t_, 'E', 1), '.', -1)"
    power = "if(contains(t_, 'E'), cast(substring_index(t_, 'E', -1) AS int), 0)"
    # Digits without zeros around them, and where the point stands: 0.digits times ten to the power of point.
    parts = let("z_", f"ltrim('0', concat({whole}, {rest}))", f"struct(d_ AS x, rtrim('0', z_) AS digits, {power} - length({rest}) + length(z_) AS point)")
    plain = "CASE WHEN p_.point <= 0 THEN concat('0.', repeat('0', -p_.point), p_.digits) WHEN p_.point >= length(p_.digits) THEN concat(p_.digits, repeat('0', p_.point - length(p_.digits))) ELSE concat(left(p_.digits, p_.point), '.', substr(p_.digits, p_.point + 1)) END"
    short = "concat(left(p_.digits, 1), if(length(p_.digits) > 1, concat('.', substr(p_.digits, 2)), ''), if(p_.point > 0, 'e+', 'e-'), abs(p_.point - 1))"
    number = f"CASE WHEN p_.x = 0 THEN '0' WHEN abs(p_.x) >= 1e-6D AND abs(p_.x) < 1e21D THEN {plain} ELSE {short} END"
    sign = "if(cast(p_.x AS string) LIKE '-%', '-', '')"
    odd = "CASE WHEN isnan(p_.x) THEN 'NaN' WHEN p_.x = double('inf') THEN '+Inf' WHEN p_.x = double('-inf') THEN '-Inf' END"
    return f"if(d_ IS NULL, NULL, {let('p_', let('t_', 'cast(abs(d_) AS string)', parts), f'coalesce({odd}, concat({sign}, {number}))')})"


def double_text(x: Column) -> Column:
    """A double as JSON writes it: the digits of its Spark text, without exponent from 1e-6 up to 1e21 (1, 0.1, 1e+21, 1.5e-7)."""
    return bound(x, "d_", double_sql())
