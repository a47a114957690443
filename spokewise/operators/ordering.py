"""Sort orders. An order is a list of column names; ``-name`` sorts downwards.

NULLs come last in both directions.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

Order = Sequence[str]


def column_of(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def order_names(order_by: Order) -> list[str]:
    return [key.removeprefix("-") for key in order_by]


def sort_columns(order_by: Order, reverse: bool = False) -> list[Column]:
    """Spark sort expressions of an order, or of its exact mirror image."""
    columns = []
    for key in order_by:
        column = column_of(key.removeprefix("-"))
        down = key.startswith("-")
        if reverse:
            columns.append(column.asc_nulls_first() if down else column.desc_nulls_first())
        else:
            columns.append(column.desc_nulls_last() if down else column.asc_nulls_last())
    return columns


def sort_rows(df: DataFrame, *order_by: str) -> DataFrame:
    return df.orderBy(*sort_columns(order_by))


def sort_by_code(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Sort a category column by the order of its levels, kept in ``<column>_code``."""
    return sort_rows(df, f"{'-' if descending else ''}{column}_code")


def key_columns(df: DataFrame, order_by: Order) -> list[Column]:
    """The columns of an order, fit to be fetched and compared with again.

    A timestamp travels as microseconds: as a local time of the driver it could
    be ambiguous.
    """
    columns = []
    for name in order_names(order_by):
        moment = isinstance(df.schema[name].dataType, TimestampType)
        columns.append(F.unix_micros(column_of(name)).alias(name) if moment else column_of(name))
    return columns


def _literal(df: DataFrame, name: str, value: object) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, TimestampNTZType) and isinstance(value, datetime.datetime):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def same_keys(a: Row, b: Row, order_by: Order) -> bool:
    """Whether two rows of key columns sort equal."""
    pairs = [(a[name], b[name]) for name in order_names(order_by)]
    return all(x == y or (x != x and y != y) for x, y in pairs)


def at_or_before(df: DataFrame, order_by: Order, cut: Row) -> Column:
    """True for rows of ``df`` that sort at or before the key values in ``cut``.

    NULL or false for all others. The values become literals, and the leading
    comparison stands alone, so that it reaches the scan.
    """
    result = F.lit(True)
    for key in reversed(order_by):
        name, down = key.removeprefix("-"), key.startswith("-")
        column = column_of(name)
        if cut[name] is None:
            earlier, equal = column.isNotNull(), column.isNull()
        else:
            bound = _literal(df, name, cut[name])
            earlier, equal = column > bound if down else column < bound, column == bound
        result = earlier | (equal & result)
    return result if cut[name] is None else result & (column >= bound if down else column <= bound)


def after(df: DataFrame, order_by: Order, cut: Row) -> Column:
    """True for rows that sort behind the key values in ``cut``, false for all others."""
    result = F.lit(False)
    for key in reversed(order_by):
        name, down = key.removeprefix("-"), key.startswith("-")
        column = column_of(name)
        if cut[name] is None:
            later, equal = F.lit(False), column.isNull()
        else:
            bound = _literal(df, name, cut[name])
            later = (column < bound if down else column > bound) | column.isNull()
            equal = column == bound
        result = later | (equal & result)
    if cut[name] is None:
        return result
    return result & ((column <= bound if down else column >= bound) | column.isNull())


def all_of_conditions(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
