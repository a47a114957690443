"""Grouped and whole-table summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spokewise.operators.long_series import along, running_sum, total as whole_sum
from spokewise.operators.ordering import column_of, sort_columns
from spokewise.session import stage

_VALUE = "__value"


def _unless_missing(column: Column, result: Column, na_rm: bool) -> Column:
    if na_rm:
        return result
    return F.when(F.count(column) == F.count(F.lit(1)), result)


def total(column: Column, na_rm: bool = False) -> Column:
    """Sum; NULL if a value is missing, unless missing values are to be skipped."""
    return _unless_missing(column, F.sum(column), na_rm)


def mean(column: Column, na_rm: bool = False) -> Column:
    return _unless_missing(column, F.avg(column), na_rm)


def deviation(column: Column, na_rm: bool = False) -> Column:
    """Sample standard deviation; NULL for a single value."""
    return _unless_missing(column, F.stddev_samp(column), na_rm)


def minimum(column: Column, na_rm: bool = False) -> Column:
    return _unless_missing(column, F.min(column), na_rm)


def maximum(column: Column, na_rm: bool = False) -> Column:
    return _unless_missing(column, F.max(column), na_rm)


def summarise(df: DataFrame, keys: Sequence[str | Column] = (), **aggregates: Column) -> DataFrame:
    """One row per group, or one row in all; a NULL key forms a group."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def count_rows(df: DataFrame, *keys: str, sort: bool = False) -> DataFrame:
    """Group sizes in column ``n``, largest first on request."""
    counted = summarise(df, keys, n=F.count(F.lit(1)))
    return counted.orderBy(*sort_columns(["-n", *keys])) if sort else counted


def missing_share(df: DataFrame) -> DataFrame:
    """One row with the share of missing values of each column."""
    return df.agg(
        *[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in df.columns]
    )


def _per_group(df: DataFrame, facts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Attach to each row the facts of its group as one struct column."""
    values = F.struct(*[column_of(c) for c in facts.columns if c not in keys])
    if not keys:
        return df.withColumn(name, facts.select(values).scalar())
    renamed = facts.select(*[column_of(k).alias(f"__group_{i}") for i, k in enumerate(keys)], values.alias(name))
    test = F.lit(True)
    for i, k in enumerate(keys):
        test = test & column_of(k).eqNullSafe(F.col(f"__group_{i}"))
    return df.join(renamed, test, "left").drop(*[f"__group_{i}" for i in range(len(keys))])


def quantiles(df: DataFrame, keys: Sequence[str], column: str, probabilities: dict[str, float]) -> DataFrame:
    """Exact quantiles per group, with linear interpolation between ranks.

    ``probabilities`` maps output names to probabilities; missing values are
    skipped. The rows are read once, into a table of the distinct values of each
    group and how often they occur; a prefix scan gives these their ranks, so a
    group of any size is spread over many tasks.
    """
    return _at_ranks(_ranked(_weighed(df, keys, column), keys), keys, probabilities)


def medians(
    df: DataFrame, keys: Sequence[str], column: str, name: str = "median", na_rm: bool = False
) -> DataFrame:
    """Exact median per group; NULL if a value is missing, unless missing values are to be skipped."""
    found = quantiles(df, keys, column, {name: 0.5})
    if na_rm:
        return found
    missing = summarise(df, [column_of(k) for k in keys], __missing=F.max(column_of(column).isNull()))
    strict = F.when(~F.col("__missing"), F.col(name)).alias(name)
    return with_group_facts(found, missing, keys).select(*[column_of(k) for k in keys], strict)


def _weighed(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The distinct values of each group, NULL among them, and how many rows have each."""
    rows = df.select(*[column_of(k) for k in keys], column_of(column).cast("double").alias(_VALUE))
    return rows.groupBy(*[column_of(k) for k in keys], _VALUE).agg(F.count(F.lit(1)).alias("__w"))


def _ranked(weighed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values in order with the rank of the last row of each, and the rows of the group."""
    weight = F.col("__w")
    values = weighed.filter(F.col(_VALUE).isNotNull())
    return along(values, [_VALUE], keys, __rank=running_sum(weight), __n=whole_sum(weight))


def _at_ranks(ranked: DataFrame, keys: Sequence[str], probabilities: dict[str, float]) -> DataFrame:
    picked = []
    for name, p in probabilities.items():
        at = (F.col("__n") - 1) * F.lit(p)
        low = F.min(F.when(F.col("__rank") >= F.floor(at) + 1, F.col(_VALUE)))
        high = F.min(F.when(F.col("__rank") >= F.ceil(at) + 1, F.col(_VALUE)))
        picked.append((low + (high - low) * F.max(at - F.floor(at))).alias(name))
    return ranked.groupBy(*[column_of(k) for k in keys]).agg(*picked)


def with_group_facts(df: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join per-group columns onto a table; a NULL key matches a NULL key."""
    joined = _per_group(df, facts, keys, "__facts")
    names = [c for c in facts.columns if c not in keys]
    return joined.select(*[column_of(c) for c in df.columns], *[F.col(f"__facts.{n}").alias(n) for n in names])


def six_statistics(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Count, mean, median, standard deviation, minimum and maximum per group.

    Mean and median skip missing values; the other three are NULL if one is
    missing. All six come from one table of weighed values.
    """
    weighed, x, weight = stage(_weighed(df, keys, column), "weighed"), F.col(_VALUE), F.col("__w")
    present = F.coalesce(F.sum(F.when(x.isNotNull(), weight)), F.lit(0))
    facts = summarise(
        weighed,
        [column_of(k) for k in keys],
        __rows=F.coalesce(F.sum(weight), F.lit(0)),
        __n=present,
        __mean=F.try_divide(F.sum(x * weight), present),
        __least=F.min(x),
        __greatest=F.max(x),
    )
    facts = stage(facts, "facts")
    # Squares of distances from the mean, which keep their digits.
    far = _per_group(weighed, facts, keys, "__f")
    far = summarise(far, [column_of(k) for k in keys], __squares=F.sum(F.pow(x - F.col("__f.__mean"), 2) * weight))
    middle = _at_ranks(_ranked(weighed, keys), keys, {"__median": 0.5})
    joined = with_group_facts(with_group_facts(facts, far, keys), middle, keys)
    whole = F.col("__n") == F.col("__rows")
    deviation = F.sqrt(F.try_divide(F.col("__squares"), F.nullif(F.col("__n") - 1, F.lit(0))))
    return joined.select(
        *[column_of(k) for k in keys],
        F.col("__rows").alias("count"),
        F.col("__mean").alias(f"avg_{column}"),
        F.col("__median").alias(f"median_{column}"),
        F.when(whole, deviation).alias(f"sd_{column}"),
        F.when(whole, F.col("__least")).alias(f"min_{column}"),
        F.when(whole, F.col("__greatest")).alias(f"max_{column}"),
    )


# Labels of price bands and the quantile each lies above.
BANDS = (("High", 0.75), ("Medium", 0.25))
LOWEST_BAND = "low"


def quantile_bands(
    df: DataFrame,
    column: str,
    bands: Sequence[tuple[str, float]] = BANDS,
    otherwise: str = LOWEST_BAND,
    name: str = "band",
) -> DataFrame:
    """Label each row by the first whole-table quantile it lies strictly above."""
    limits = quantiles(df, [], column, {f"q{i}": p for i, (_, p) in enumerate(bands)})
    limit = limits.select(F.struct("*")).scalar()
    df = df.withColumn("__limit", limit)
    label = F.lit(None).cast("string")
    for i, (text, _) in reversed(list(enumerate(bands))):
        rest = F.lit(otherwise) if i == len(bands) - 1 else label
        label = F.when(F.col(column) > F.col(f"__limit.q{i}"), text).otherwise(rest)
    return df.withColumn(name, label).drop("__limit")


def linear_trend(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of ``y`` on ``x``, one per group."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return summarise(df, keys, slope=F.regr_slope(b, a), intercept=F.regr_intercept(b, a))


def with_trend(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``slope``, ``intercept`` and the ``fitted`` value of the group's line."""
    fitted = F.col("intercept") + F.col("slope") * F.col(x)
    return with_group_facts(df, linear_trend(df, x, y, keys), keys).withColumn("fitted", fitted)


def box_statistics(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Quartiles, whisker ends within 1.5 quartile ranges, and outliers per group, from one table of weighed values."""
    quarters = {"least": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "greatest": 1.0}
    ranked = stage(_ranked(_weighed(df, keys, column), keys), "ranked")
    marks = _at_ranks(ranked, keys, quarters)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    marks = stage(
        marks.withColumns({"__low": F.col("q1") - reach, "__high": F.col("q3") + reach}), "marks"
    )
    x, weight = F.col(_VALUE), F.col("__w")
    inside = x.between(F.col("__m.__low"), F.col("__m.__high"))
    measured = summarise(
        _per_group(ranked, marks, keys, "__m"),
        [column_of(k) for k in keys],
        whisker_low=F.min(F.when(inside, x)),
        whisker_high=F.max(F.when(inside, x)),
        outliers=F.coalesce(F.sum(F.when(~inside, weight)), F.lit(0)),
    )
    fixed = [F.col(f"__m.{n}").alias(n) for n in quarters]
    return _per_group(measured, marks, keys, "__m").select(
        *[column_of(k) for k in keys], *fixed, "whisker_low", "whisker_high", "outliers"
    )
