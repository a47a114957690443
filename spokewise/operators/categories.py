"""Ordered categories.

A category column stays text. The order of its levels is a table
``(level, code)`` with codes from 1; :func:`with_codes` joins the codes back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spokewise.operators.aggregates import quantiles
from spokewise.operators.ordering import Order, column_of, order_names
from spokewise.operators.positions import row_index
from spokewise.session import stage


def _numbered(levels: DataFrame, order_by: Order) -> DataFrame:
    """Number the levels in the given order, partition by partition of a range sort."""
    return row_index(levels, order_by, "code").select("level", F.col("code").cast("int"))


def _present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(column_of(column).isNotNull())


def levels_by_appearance(df: DataFrame, column: str, order_by: Order) -> DataFrame:
    """Levels in the order in which they first appear when rows are sorted upwards.

    Numbers become levels by value instead, see :func:`levels_by_value`.
    """
    names = order_names(order_by)
    # min() skips NULLs, and a level with nothing else gets NULL, which sorts last.
    # A struct needs the flag for the same effect, and a sort-based aggregate.
    if any(key.startswith("-") for key in order_by):
        raise ValueError("the order of appearance sorts upwards; negate the column instead")
    if len(names) == 1:
        first = F.min(column_of(names[0]))
    else:
        first = F.min(F.struct(*[F.struct(column_of(n).isNull(), column_of(n)) for n in names]))
    levels = _present(df, column).groupBy(column_of(column).alias("level")).agg(first.alias("__first"))
    return _numbered(levels, ["__first", "level"])


def levels_by_value(df: DataFrame, column: str) -> DataFrame:
    """Levels in alphabetic order, or numbers by value."""
    levels = _present(df, column).select(column_of(column).alias("level")).distinct()
    return _numbered(levels, ["level"])


def levels_by_summary(
    df: DataFrame, column: str, by: str, summary: Column | None = None, descending: bool = False
) -> DataFrame:
    """Levels by the median of another column, or by another aggregate of it.

    Ties fall back to alphabetic order.
    """
    rows = _present(df, column).withColumnRenamed(column, "level")
    if summary is None:
        levels = quantiles(rows, ["level"], by, {"__by": 0.5})
        levels = rows.select("level").distinct().join(levels, "level", "left")
    else:
        levels = rows.groupBy("level").agg(summary.alias("__by"))
    return _numbered(levels, ["-__by" if descending else "__by", "level"])


def levels_by_last(df: DataFrame, column: str, x: str, y: str) -> DataFrame:
    """Levels by their ``y`` at the greatest ``x``, largest first."""
    rows = _present(df, column).filter(column_of(y).isNotNull() & column_of(x).isNotNull())
    levels = rows.groupBy(column_of(column).alias("level")).agg(F.max_by(column_of(y), column_of(x)).alias("__last"))
    return _numbered(levels, ["-__last", "level"])


def reverse_levels(levels: DataFrame) -> DataFrame:
    last = levels.agg(F.max("code")).scalar()
    return levels.withColumn("code", last + 1 - F.col("code"))


def relevel(levels: DataFrame, moved: Sequence[str], after: int = 0) -> DataFrame:
    """Move the named levels behind the first ``after`` others; the rest keep their order."""
    place = F.lit(None).cast("int")
    for i, level in enumerate(moved):
        place = F.when(F.col("level") == level, i).otherwise(place)
    others = levels.filter(~F.col("level").isin(list(moved)))
    at = others.orderBy("code").offset(after - 1).limit(1).select("code").scalar() if after else F.lit(0)
    ordered = levels.withColumn("__place", place).withColumn(
        "__group",
        F.when(F.col("__place").isNotNull(), 1)
        # Fewer others than ``after``: the limit is NULL and all of them come first.
        .when(F.coalesce(F.col("code") <= at, F.lit(True)), 0)
        .otherwise(2),
    )
    return _numbered(
        ordered.select("level", "__group", F.coalesce("__place", "code").alias("__rank")),
        ["__group", "__rank"],
    )


def with_codes(df: DataFrame, column: str, levels: DataFrame, name: str | None = None) -> DataFrame:
    """Add the integer code of each value, by default as ``<column>_code``."""
    codes = levels.select(
        F.col("level").alias("__level"), F.col("code").alias(name or f"{column}_code")
    )
    return df.join(codes, column_of(column) == F.col("__level"), "left").drop("__level")


def lump(
    df: DataFrame, column: str, n: int, weight: str | None = None, other: str = "Other"
) -> DataFrame:
    """Keep the ``n`` heaviest values of a column, and call the rest ``other``.

    Weight is the row count, or the sum of ``weight``. Values tied with the
    n-th are kept, and a single left-over value is not renamed. Sum the result
    again to get one row per group.
    """
    if n < 1:
        raise ValueError("keep at least one value")
    measure = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(column_of(weight)), F.lit(0))
    present = _present(df, column)
    # Staged, so that its written size tells Spark whether to broadcast it.
    weights = stage(
        present.groupBy(column_of(column).alias("__level")).agg(measure.alias("__w")), "weights"
    )
    heaviest = weights.select("__w").orderBy(F.col("__w").desc_nulls_last()).limit(n)
    light = weights.filter(F.col("__w") < heaviest.agg(F.min("__w")).scalar())
    several = light.agg(F.count(F.lit(1))).scalar() > 1
    renamed = light.filter(several).select("__level", F.lit(True).alias("__light"))
    return (
        df.join(renamed, column_of(column) == F.col("__level"), "left")
        .withColumn(column, F.when(F.col("__light"), other).otherwise(column_of(column)))
        .drop("__level", "__light")
    )
