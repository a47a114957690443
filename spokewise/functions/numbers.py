"""Arithmetic, conversion and conditional expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def natural_log(column: Column) -> Column:
    """Natural logarithm; NULL for zero and below."""
    return F.ln(column)


def power(column: Column, exponent: float) -> Column:
    return F.pow(column, F.lit(exponent))


def to_number(text: Column, kind: str = "double") -> Column:
    """Number from text; NULL where the text is no number."""
    return text.try_cast(kind)


def first_case(cases: Sequence[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    """Value of the first true condition. A NULL condition is no match."""
    result = F
    for condition, value in cases:
        result = result.when(condition, value)
    return result.otherwise(otherwise)


def recode(column: Column, changes: Mapping[str, str]) -> Column:
    """Replace listed values; all others stay."""
    return first_case([(column == old, F.lit(new)) for old, new in changes.items()], column)
