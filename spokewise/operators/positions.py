"""Operators on row positions.

A Spark table has no row order, so every operator here takes an order, best
with a unique tie-break. A whole-table ``row_number`` would pull all rows into
one task. Instead rows are range-partitioned by the full order (a hot leading
value is split by the later keys), numbered inside their partition and staged;
the row counts of the partitions then turn local numbers into positions.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import MapType, VariantType

from spokewise.operators.ordering import (
    Order,
    after,
    at_or_before,
    column_of,
    key_columns,
    same_keys,
    sort_columns,
    sort_rows,
)
from spokewise.session import stage

SLOT = "__slot"
_PART = "__part"
_BASE = "__base"
_TIE = "__tie"
# monotonically_increasing_id keeps the partition number above this bit.
PART_SHIFT = 33
# Up to here a position is found with a top-k sort, to which every task sends that
# many rows; beyond, with staged positions. Both follow one order, down to ties.
SHORT_RANGE = 100


def settled(df: DataFrame, order_by: Order) -> tuple[DataFrame, Order]:
    """The table and its order with a hash of the row as the last key.

    Rows that are equal in the order then have a fixed order, too, unless they are
    equal altogether.
    """
    plain = [column_of(f.name) for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
    return df.withColumn(_TIE, F.xxhash64(*plain)), [*order_by, _TIE]


class PlacedRows:
    """Staged rows with their slot, and the row counts needed to address them."""

    def __init__(self, df: DataFrame, order_by: Order):
        columns = sort_columns(order_by)
        self.rows = stage(
            df.repartitionByRange(*columns)
            .sortWithinPartitions(*columns)
            .withColumn(SLOT, F.monotonically_increasing_id()),
            "positions",
        )
        # One row per partition, so bounded by the number of shuffle partitions.
        counts = self.rows.groupBy(F.shiftright(SLOT, PART_SHIFT).alias(_PART)).count().collect()
        counts.sort(key=lambda row: row[_PART])
        self.parts = [row[_PART] for row in counts]
        ends = list(accumulate(row["count"] for row in counts))
        self.bases = [0, *ends[:-1]]
        self.count = ends[-1] if ends else 0

    def with_index(self, name: str) -> DataFrame:
        spark = self.rows.sparkSession
        bases = spark.createDataFrame(
            list(zip(self.parts, self.bases)), f"{_PART} bigint, {_BASE} bigint"
        )
        local = F.col(SLOT).bitwiseAND(F.lit((1 << PART_SHIFT) - 1))
        return (
            self.rows.withColumn(_PART, F.shiftright(SLOT, PART_SHIFT))
            .join(F.broadcast(bases), _PART)
            .withColumn(name, F.col(_BASE) + local + 1)
            .drop(_PART, _BASE, SLOT)
        )

    def at(self, positions: Sequence[int]) -> dict[int, Row]:
        """The rows at the given positions (1-based, each within the table)."""
        slots = {}
        for position in positions:
            i = bisect_right(self.bases, position - 1) - 1
            slots[(self.parts[i] << PART_SHIFT) + position - 1 - self.bases[i]] = position
        found = self.rows.filter(F.col(SLOT).isin(list(slots))).collect()
        return {slots[row[SLOT]]: row for row in found}


def row_index(df: DataFrame, order_by: Order, name: str = "row_index") -> DataFrame:
    """Add the 1-based position of every row in the given order."""
    return PlacedRows(df, order_by).with_index(name)


def _cuts(
    df: DataFrame, order_by: Order, positions: Sequence[int]
) -> list[tuple[Column, Column]] | None:
    """For each position p, a condition for the first p rows, and one for all others.

    None when rows with equal keys lie on both sides of a cut, so that no
    condition on the keys can tell them apart.
    """
    keys = df.select(*key_columns(df, order_by))
    if max(positions) <= SHORT_RANGE:
        def pair(position: int) -> list[Row]:
            return keys.orderBy(*sort_columns(order_by)).offset(position - 1).limit(2).collect()
    else:
        placed = PlacedRows(keys, order_by)
        wanted = {q for p in positions for q in (p, p + 1) if q <= placed.count}
        rows = placed.at(sorted(wanted)) if wanted else {}

        def pair(position: int) -> list[Row]:
            return [rows[q] for q in (position, position + 1) if q in rows]

    conditions = []
    for position in positions:
        around = pair(position)
        if len(around) < 2:
            conditions.append((F.lit(True), F.lit(False)))
        elif same_keys(around[0], around[1], order_by):
            return None
        else:
            first, rest = at_or_before(df, order_by, around[0]), after(df, order_by, around[0])
            conditions.append((first, rest))
    return conditions


def slice_rows(df: DataFrame, order_by: Order, start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop`` of the order, both 1-based and included."""
    if start < 1 or stop < start:
        raise ValueError(f"not a row range: {start}..{stop}")
    df, order_by = settled(df, order_by)
    return _slice(df, order_by, start, stop).drop(_TIE)


def _slice(df: DataFrame, order_by: Order, start: int, stop: int) -> DataFrame:
    if stop <= SHORT_RANGE:
        return df.orderBy(*sort_columns(order_by)).offset(start - 1).limit(stop - start + 1)
    positions = [stop] if start == 1 else [start - 1, stop]
    cuts = _cuts(df, order_by, positions)
    if cuts is None:
        name = "__row_index"
        return row_index(df, order_by, name).filter(F.col(name).between(start, stop)).drop(name)
    last = cuts[-1][0]
    return df.filter(last if start == 1 else cuts[0][1] & last)


def split_at(df: DataFrame, order_by: Order, cut: int) -> tuple[DataFrame, DataFrame]:
    """The first ``cut`` rows of the order, and all others."""
    if cut < 1:
        raise ValueError("the cut must be at least 1")
    df, order_by = settled(df, order_by)
    first, rest = _split(df, order_by, cut)
    return first.drop(_TIE), rest.drop(_TIE)


def _split(df: DataFrame, order_by: Order, cut: int) -> tuple[DataFrame, DataFrame]:
    cuts = _cuts(df, order_by, [cut])
    if cuts is None:
        name = "__row_index"
        indexed = row_index(df, order_by, name)
        first = indexed.filter(F.col(name) <= cut).drop(name)
        return first, indexed.filter(F.col(name) > cut).drop(name)
    first, rest = cuts[0]
    return df.filter(first), df.filter(rest)


def last_rows(df: DataFrame, order_by: Order, count: int = 6) -> DataFrame:
    """The last rows of the order, shown in that order."""
    if count > SHORT_RANGE:
        size = df.count()
        return sort_rows(slice_rows(df, order_by, max(size - count, 0) + 1, size), *order_by)
    df, order_by = settled(df, order_by)
    last = df.orderBy(*sort_columns(order_by, reverse=True)).limit(count)
    return last.orderBy(*sort_columns(order_by)).drop(_TIE)


def first_rows(df: DataFrame, order_by: Order, count: int) -> DataFrame:
    """The first rows of the order, shown in that order."""
    return sort_rows(slice_rows(df, order_by, 1, count), *order_by)


def null_first_rows(df: DataFrame, column: str, order_by: Order, count: int) -> DataFrame:
    """Set ``column`` to NULL in the first ``count`` rows of the order."""
    df, order_by = settled(df, order_by)
    cuts = _cuts(df, order_by, [count])
    if cuts is None:
        name = "__row_index"
        indexed = row_index(df, order_by, name)
        return indexed.withColumn(column, F.when(F.col(name) > count, column_of(column))).drop(name, _TIE)
    return df.withColumn(column, F.when(cuts[0][1], column_of(column))).drop(_TIE)


def bucket_ends(count: int, buckets: int) -> list[int]:
    """Last position of each of ``buckets`` near-equal runs; the longer runs come first."""
    size, longer = divmod(count, buckets)
    return list(accumulate(size + (i < longer) for i in range(buckets)))


def equal_buckets(
    df: DataFrame, column: str, buckets: int, tie_break: Order, name: str = "bucket"
) -> DataFrame:
    """Add a bucket number 1..``buckets`` of near-equal size by ``column``; NULL stays NULL.

    Only the key columns are range-partitioned to find the cuts. The rows
    themselves are then labelled in place, without a shuffle.
    """
    order_by = [column, *tie_break]
    present = df.filter(column_of(column).isNotNull())
    placed = PlacedRows(present.select(*key_columns(df, order_by)), order_by)
    ends = bucket_ends(placed.count, buckets)
    wanted = {q for p in ends for q in (p, p + 1) if 1 <= q <= placed.count}
    rows = placed.at(sorted(wanted)) if wanted else {}

    label = F.lit(1)
    for end in ends[:-1]:
        if end == 0 or end == placed.count:
            if end == 0:
                label = label + 1
            continue
        if same_keys(rows[end], rows[end + 1], order_by):
            return _buckets_by_index(df, order_by, ends, name)
        label = label + after(df, order_by, rows[end]).cast("int")
    return df.withColumn(name, F.when(column_of(column).isNotNull(), label))


def _buckets_by_index(df: DataFrame, order_by: Order, ends: list[int], name: str) -> DataFrame:
    # NULLs sort last, so they do not move the positions of the other rows.
    position = "__row_index"
    label = F.lit(1)
    for end in ends[:-1]:
        label = label + (F.col(position) > end).cast("int")
    column = column_of(order_by[0].removeprefix("-"))
    indexed = row_index(df, order_by, position)
    return indexed.withColumn(name, F.when(column.isNotNull(), label)).drop(position)
