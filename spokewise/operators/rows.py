"""Choosing rows by condition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spokewise.operators.ordering import all_of_conditions, column_of


def keep_rows(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows for which every condition is true; a NULL condition drops the row."""
    return df.filter(all_of_conditions(conditions))


def not_in(column: Column, values: Sequence[object]) -> Column:
    """True unless the value is listed; a NULL value counts as not listed."""
    return ~F.coalesce(column.isin(list(values)), F.lit(False))


def above_mean(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is above the mean of the table (a scalar subquery)."""
    return df.filter(column_of(column) > df.agg(F.avg(column_of(column))).scalar())


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in every named column."""
    return keep_rows(df, *[column_of(c).isNotNull() for c in columns])


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows, or distinct combinations of the named columns only."""
    return (df.select(*[column_of(c) for c in columns]) if columns else df).distinct()
