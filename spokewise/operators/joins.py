"""Joins and row or column binds.

No join carries a broadcast hint: table sizes are not known here, so Spark
picks the strategy from the measured sizes, and adaptive execution splits a hot
key over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from spokewise.operators.ordering import Order, column_of
from spokewise.operators.positions import PlacedRows


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str] | Sequence[str],
    na_matches: bool = False,
    suffixes: tuple[str, str] = (".x", ".y"),
) -> DataFrame:
    """Keep all left rows and all matches; the right key columns are dropped.

    ``on`` maps left to right names, or lists shared names. With
    ``na_matches`` a NULL key matches a NULL key. Other names on both sides
    get the suffixes; a suffixed name that is taken already is an error.
    """
    pairs = on if isinstance(on, dict) else {name: name for name in on}
    keys = {old: f"__right_{i}" for i, old in enumerate(pairs.values())}
    shared = {c for c in left.columns if c in right.columns and c not in keys}
    for suffix in suffixes:
        taken = {c + suffix for c in shared} & {*left.columns, *right.columns}
        if taken:
            raise ValueError(f"names are taken: {sorted(taken)}")
    # A left key keeps its name, as the join condition and the result need it.
    left_names = {c: c + suffixes[0] for c in shared if c not in pairs}
    left = left.withColumnsRenamed(left_names)
    right = right.withColumnsRenamed(keys | {c: c + suffixes[1] for c in shared})
    tests = []
    for name, old in pairs.items():
        a, b = column_of(name), F.col(keys[old])
        tests.append(a.eqNullSafe(b) if na_matches else a == b)
    joined = left.join(right, reduce(lambda a, b: a & b, tests), "left")
    return joined.drop(*keys.values())


def star_join(fact: DataFrame, *dimensions: tuple[DataFrame, dict[str, str]]) -> DataFrame:
    """Left-join each dimension onto the fact table by its ``{fact key: dimension key}``."""
    for dimension, on in dimensions:
        fact = left_join(fact, dimension, on)
    return fact


def cast_keys(df: DataFrame, *keys: str, to: str = "bigint") -> DataFrame:
    """Bring join keys to one type; text that is no number becomes NULL."""
    return df.withColumns({k: column_of(k).try_cast(to) for k in keys})


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once. Empty for a proper dimension."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def bind_columns(
    left: DataFrame, right: DataFrame, left_order: Order, right_order: Order
) -> DataFrame:
    """Put two tables of equal length side by side, row by row in their orders."""
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    name = "__row_index"
    a, b = PlacedRows(left, left_order), PlacedRows(right, right_order)
    if a.count != b.count:
        raise ValueError(f"tables of {a.count} and {b.count} rows cannot be bound")
    return a.with_index(name).join(b.with_index(name), name).drop(name)


def bind_rows(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; an absent column is filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
