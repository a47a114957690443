"""Numbers as text, for the last step of a report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from spokewise.operators.columns import quoted

# Fixed value: up to this largest amount a column of money shows cents.
LARGEST_WITH_CENTS = 100_000


def number_text(
    column: Column,
    decimals: int = 0,
    scale: float = 1.0,
    prefix: str = "",
    suffix: str = "",
    thousands: bool = True,
) -> Column:
    """Number with thousands marks, prefix and suffix; the sign comes first."""
    scaled = column * F.lit(scale) if scale != 1.0 else column
    digits = F.format_number(F.abs(scaled), decimals)
    # What rounds to zero has no sign.
    nothing = F.lit(f"{0:.{decimals}f}")
    if not thousands:
        digits = F.replace(digits, F.lit(","), F.lit(""))
    sign = F.when((scaled < 0) & (digits != nothing), "-").otherwise("")
    return F.concat(sign, F.lit(prefix), digits, F.lit(suffix))


def dollar_text(column: Column, cents: bool = False, scale: float = 1.0, suffix: str = "") -> Column:
    return number_text(column, 2 if cents else 0, scale, "$", suffix)


def percent_text(column: Column, accuracy: float = 0.1) -> Column:
    """Share as percent text, in steps of 1, 0.1, 0.01 ... percent."""
    decimals = max(len(f"{accuracy:f}".rstrip("0").split(".")[1]), 0)
    return number_text(column, decimals, 100.0, suffix="%")


def with_dollar_texts(
    df: DataFrame,
    names: Mapping[str, str],
    largest_with_cents: float = LARGEST_WITH_CENTS,
    scale: float = 1.0,
    suffix: str = "",
) -> DataFrame:
    """Add money text for each column, under the name it maps to.

    Cents show in a column only if all of it is small and it has fractions. One
    aggregate over the table settles that for all columns (a scalar subquery).
    """
    choices, texts = [], {}
    for i, (column, name) in enumerate(names.items()):
        value = F.col(quoted(column))
        amount = value * F.lit(scale) if scale != 1.0 else value
        small = F.max(F.abs(amount)) <= largest_with_cents
        broken = F.max((amount != F.floor(amount)).cast("int")) == 1
        choices.append(F.coalesce(small & broken, F.lit(False)).alias(f"c{i}"))
        texts[name] = F.when(
            F.col(f"__cents.c{i}"), dollar_text(value, True, scale, suffix)
        ).otherwise(dollar_text(value, False, scale, suffix))
    choice = df.agg(*choices).select(F.struct("*")).scalar()
    return df.withColumn("__cents", choice).withColumns(texts).drop("__cents")


def with_dollar_text(
    df: DataFrame,
    column: str,
    name: str | None = None,
    largest_with_cents: float = LARGEST_WITH_CENTS,
    scale: float = 1.0,
    suffix: str = "",
) -> DataFrame:
    """Add money text for one column, by default as ``<column>_text``."""
    return with_dollar_texts(
        df, {column: name or f"{column}_text"}, largest_with_cents, scale, suffix
    )
