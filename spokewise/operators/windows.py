"""Expressions over an ordered series, such as monthly sales.

A window without a partition runs in one task. That suits a series already
summed to calendar periods; it does not suit order lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from spokewise.operators.ordering import Order, sort_columns


def series(order_by: Order, within: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*within).orderBy(*sort_columns(order_by))


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _whole(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _unless_missing(column: Column, frame: WindowSpec, result: Column) -> Column:
    return F.when(~F.max(column.isNull()).over(frame), result)


def previous(column: Column, window: WindowSpec, steps: int = 1, fill_self: bool = False) -> Column:
    """The value ``steps`` rows earlier; where there is none, NULL or the row's own value."""
    earlier = F.lag(column, steps).over(window)
    return F.coalesce(earlier, column) if fill_self else earlier


def relative_change(column: Column, base: Column) -> Column:
    """(column - base) / base, NULL for a zero base."""
    return F.try_divide(column - base, base)


def first_value(column: Column, window: WindowSpec) -> Column:
    return F.first(column).over(_whole(window))


def running_sum(column: Column, window: WindowSpec) -> Column:
    """Sum of the rows so far; NULL from the first missing value on."""
    frame = _so_far(window)
    return _unless_missing(column, frame, F.sum(column).over(frame))


def running_mean(column: Column, window: WindowSpec) -> Column:
    frame = _so_far(window)
    return _unless_missing(column, frame, F.avg(column).over(frame))


def running_share(column: Column, window: WindowSpec) -> Column:
    """Running sum over the total of the series; NULL where either is undefined."""
    frame = _whole(window)
    whole = _unless_missing(column, frame, F.sum(column).over(frame))
    return F.try_divide(running_sum(column, window), whole)


def _trailing(
    column: Column, window: WindowSpec, length: int, fill: float | None, result: Column
) -> Column:
    frame = window.rowsBetween(1 - length, Window.currentRow)
    value = _unless_missing(column, frame, result)
    return F.when(F.row_number().over(window) >= length, value).otherwise(
        F.lit(fill).cast("double")
    )


def trailing_mean(
    column: Column, window: WindowSpec, length: int, fill: float | None = 0.0
) -> Column:
    """Mean of the last ``length`` rows; ``fill`` where there are fewer."""
    frame = window.rowsBetween(1 - length, Window.currentRow)
    return _trailing(column, window, length, fill, F.avg(column).over(frame))


def trailing_median(
    column: Column, window: WindowSpec, length: int, fill: float | None = 0.0
) -> Column:
    frame = window.rowsBetween(1 - length, Window.currentRow)
    ordered = F.array_sort(F.collect_list(column).over(frame))
    half = length // 2
    middle = F.get(ordered, F.lit(half))
    if length % 2 == 0:
        middle = (F.get(ordered, F.lit(half - 1)) + middle) / 2
    return _trailing(column, window, length, fill, middle.cast("double"))


def with_change(
    df: DataFrame,
    column: str,
    order_by: Order,
    within: Sequence[str] = (),
    change: str = "pct_diff",
) -> DataFrame:
    """Add ``<column>_lag_1`` and the relative change from the previous row.

    The first row is compared with itself, so its change is 0. Use with
    ``DataFrame.transform``.
    """
    lagged = f"{column}_lag_1"
    df = df.withColumn(
        lagged, previous(F.col(column), series(order_by, within), fill_self=True)
    )
    return df.withColumn(change, relative_change(F.col(column), F.col(lagged)))
