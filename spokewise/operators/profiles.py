"""Profile of every column of a table: missing and distinct values, quantiles and histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, FractionalType, NumericType, TimestampNTZType, TimestampType

from spokewise.operators.aggregates import with_group_facts
from spokewise.operators.columns import quoted
from spokewise.operators.long_series import along, running_sum, total as whole_sum
from spokewise.session import stage

QUANTILES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}
BINS = 10
# A longer text is counted by its SHA-256, so that no key of the shuffle is longer than this by more than a sign.
LONGEST_KEY = 64


def _number(column: Column, kind: DataType) -> Column:
    """Numbers as they are, dates as days and timestamps as seconds since 1970, NULL for other types."""
    if isinstance(kind, NumericType):
        value = column.cast("double") + F.lit(0.0)
        return F.when(~F.isnan(value), value)
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return column.cast("timestamp").cast("double")
    return F.lit(None).cast("double")


def _key(column: Column, kind: DataType) -> Column:
    """Text that is equal for equal values, NULL for a missing one."""
    if isinstance(kind, FractionalType):
        return F.when(~F.isnan(column.cast("double")), (column + F.lit(0).cast(kind)).cast("string"))
    if isinstance(kind, (NumericType, BooleanType)):
        return column.cast("string")
    text = column.cast("string")
    return F.when(F.length(text) > LONGEST_KEY, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def full_profile(df: DataFrame, columns: Sequence[str] | None = None, bins: int = BINS) -> DataFrame:
    """One row per column: column, rows, missing, distinct, p0, p25, p50, p75, p100, histogram.

    NaN counts as missing. Quantiles are exact, with linear interpolation; ``histogram`` has the number
    of values in each of ``bins`` equally wide bins from least to greatest, the last one closed. Both are
    NULL for columns that are neither numbers nor dates and for columns without values.

    The table is read once and unfolded to one row per cell. Counting equal cells of a column first
    within each task and then by their value spreads every column over all tasks; all figures follow
    from these counts, distinct values without a ``count(distinct)`` and ranks by a prefix scan.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    cells = [
        F.struct(
            F.lit(f.name).alias("column"),
            _key(F.col(quoted(f.name)), f.dataType).alias("key"),
            _number(F.col(quoted(f.name)), f.dataType).alias("x"),
        )
        for f in fields
    ]
    counted = df.select(F.inline(F.array(*cells))).groupBy("column", "key", "x").agg(F.count("*").alias("w"))
    counted = stage(counted, "profile")
    facts = counted.groupBy("column").agg(
        F.sum("w").alias("rows"),
        F.sum(F.when(F.col("key").isNull(), F.col("w")).otherwise(0)).alias("missing"),
        F.count("key").alias("distinct"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
    )
    values = counted.filter(F.col("x").isNotNull()).select("column", "x", "w")
    ranked = along(values, ["x"], ["column"], rank=running_sum(F.col("w")), n=whole_sum(F.col("w")))
    marks = []
    for name, p in QUANTILES.items():
        at = (F.col("n") - 1) * F.lit(p)
        low, high = (F.min(F.when(F.col("rank") >= place + 1, F.col("x"))) for place in (F.floor(at), F.ceil(at)))
        marks.append((low + (high - low) * F.max(at - F.floor(at))).alias(name))
    quantiles = ranked.groupBy("column").agg(*marks)
    share = F.try_divide(F.col("x") - F.col("low"), F.col("high") - F.col("low"))
    place = F.least(F.coalesce(F.floor(share * bins), F.lit(0)), F.lit(bins - 1))
    placed = with_group_facts(values, facts.select("column", "low", "high"), ["column"]).select("column", place.alias("bin"), "w")
    bars = [F.coalesce(F.sum(F.when(F.col("bin") == k, F.col("w"))), F.lit(0)) for k in range(bins)]
    histograms = placed.groupBy("column").agg(F.array(*bars).alias("histogram"))
    # A table without rows has its columns too.
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f.name) for f in fields])).alias("column"))
    for part in (facts.drop("low", "high"), quantiles, histograms):
        names = names.join(part, "column", "left")
    counts = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("rows", "missing", "distinct")}
    return names.withColumns(counts).select("column", "rows", "missing", "distinct", *QUANTILES, "histogram")
