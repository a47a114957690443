"""Figures along a series of any length, such as all order lines by date.

The windows of :mod:`spokewise.operators.windows` run a series without groups, or a hot
group, in one task. Here the rows are range-partitioned by the full order, so that a hot
date or group is split, and staged. One aggregate per partition follows; the driver
carries these totals forward over the partitions, of which there are as many as shuffle
partitions. Each partition also gets the last rows of those before it, as many as its
figures look back. With both, every partition works out its own rows.

Trailing sums are put together from sums of 10, 100 and so on rows, each of ten earlier ones, so a
row costs a few additions for any length, and only values of its own frame are ever added.

The figures are those of ``windows`` and have the same results: NULL from the first
missing value on, or where a frame has one, and NULL for a zero base. Rows that are equal
in the order follow each other by a hash of the row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from spokewise.operators.ordering import Order, column_of, key_columns
from spokewise.operators.positions import PART_SHIFT, SLOT, PlacedRows, settled

_AT, _POS, _OWN, _IN = "__at", "__pos", "__own", "__in"
# Rows of one level of trailing sums that make one of the next.
_STEP = 10


@dataclass(frozen=True)
class Figure:
    """A value per row: its column, what it is along the series, and how many rows it looks back."""

    column: Column
    result: Callable[[Along], Column]
    back: int = 0
    sums: bool = False
    firsts: bool = False
    trailing: int = 0


def running_sum(column: Column) -> Figure:
    """Sum of the rows so far; NULL from the first missing value on."""
    return Figure(column, lambda s: F.when(s.missing_so_far() == 0, s.sum_so_far()), sums=True)


def running_mean(column: Column) -> Figure:
    return Figure(column, lambda s: F.when(s.missing_so_far() == 0, s.sum_so_far() / s.place()), sums=True)


def running_share(column: Column) -> Figure:
    """Running sum over the total of the series; NULL where either is undefined."""
    return Figure(
        column, lambda s: F.when(s.total("missing") == 0, F.try_divide(s.sum_so_far(), s.total("sum"))), sums=True
    )


def total(column: Column) -> Figure:
    """Sum of the whole series; NULL if a value is missing."""
    return Figure(column, lambda s: F.when(s.total("missing") == 0, s.total("sum")), sums=True)


def running_count(column: Column) -> Figure:
    """How many rows so far have a value."""
    return Figure(column, lambda s: s.place() - s.missing_so_far())


def first_value(column: Column) -> Figure:
    return Figure(column, lambda s: s.first(), firsts=True)


def previous(column: Column, steps: int = 1, fill_self: bool = False) -> Figure:
    """The value ``steps`` rows earlier; where there is none, NULL or the row's own value."""

    def result(s: Along) -> Column:
        earlier = F.lag(s.value, steps).over(s.window)
        return F.coalesce(earlier, s.value) if fill_self else earlier

    return Figure(column, result, back=steps)


def _trailing(column: Column, length: int, fill: float | None, of: Callable[[Column], Column]) -> Figure:
    if length < 1:
        raise ValueError("a trailing figure needs a length of one row or more")

    def result(s: Along) -> Column:
        value = of(s.trailing_sum(length).cast("double"))
        return F.when(s.place() >= length, value).otherwise(F.lit(fill).cast("double"))

    return Figure(column, result, back=length - 1, trailing=length)


def trailing_mean(column: Column, length: int, fill: float | None = 0.0) -> Figure:
    """Mean of the last ``length`` rows; ``fill`` where there are fewer."""
    return _trailing(column, length, fill, lambda total: total / length)


def trailing_sum(column: Column, length: int, fill: float | None = 0.0) -> Figure:
    return _trailing(column, length, fill, lambda total: total)


def _with_trailing_sums(rows: DataFrame, number: int, length: int, window) -> DataFrame:
    """Add the sums of the last 1, 10, 100, ... rows up to ``length``; NULL where a value is missing."""
    kind = rows.schema[f"__x{number}"].dataType
    if isinstance(kind, T.DecimalType):
        kind = T.DecimalType(min(kind.precision + 10, 38), kind.scale)
    else:
        kind = T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()
    rows, span = rows.withColumn(_last(number, 1), F.col(f"__x{number}").cast(kind)), 1
    while span * _STEP <= length:
        smaller, total = F.col(_last(number, span)), F.col(_last(number, span))
        for k in range(1, _STEP):
            total = (total + F.lag(smaller, k * span).over(window)).cast(kind)
        span *= _STEP
        rows = rows.withColumn(_last(number, span), total)
    return rows


def _last(number: int, span: int) -> str:
    return f"__x{number}_last{span}"


class Along:
    """What a figure's result is made of: windows over a partition's own rows, and what came before them."""

    def __init__(self, number: int, window, summed: bool):
        self.window, self.number = window, number
        self.value = F.col(f"__x{number}")
        self._own = F.when(F.col(_OWN), self.value) if summed else None
        self._so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self._whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # The first group of a partition may have begun, and its last one go on, elsewhere.
        self._is_head = F.min(F.when(F.col(_OWN), F.col(_POS))).over(self._whole) == F.col(f"{_IN}.first_pos")
        self._is_tail = F.max(F.when(F.col(_OWN), F.col(_POS))).over(self._whole) == F.col(f"{_IN}.last_pos")

    def _local(self, what: str, frame) -> Column:
        if what == "sum":
            return F.coalesce(F.sum(self._own).over(frame), F.lit(0))
        if what == "missing":
            return F.sum(F.when(F.col(_OWN) & self.value.isNull(), 1).otherwise(0)).over(frame)
        return F.sum(F.when(F.col(_OWN), 1).otherwise(0)).over(frame)

    def _name(self, what: str) -> str:
        return what if what == "count" else f"{what}{self.number}"

    def _with_carry(self, what: str) -> Column:
        carried = F.when(self._is_head, F.col(f"{_IN}.before.{self._name(what)}"))
        return self._local(what, self._so_far) + F.coalesce(carried, F.lit(0))

    def trailing_sum(self, length: int) -> Column:
        """Sum of the last ``length`` rows, of which there must be that many; NULL if a value is missing."""
        span, done, total = 1, 0, None
        while span * _STEP <= length:
            span *= _STEP
        while done < length:
            while span > length - done:
                span //= _STEP
            part = F.col(_last(self.number, span))
            part = F.lag(part, done).over(self.window) if done else part
            total, done = part if total is None else total + part, done + span
        return total

    def sum_so_far(self) -> Column:
        return self._with_carry("sum")

    def missing_so_far(self) -> Column:
        return self._with_carry("missing")

    def place(self) -> Column:
        return self._with_carry("count")

    def total(self, what: str) -> Column:
        """``sum`` or ``missing`` of the whole series or group, wherever its rows are."""
        name = self._name(what)
        return (
            F.when(self._is_head, F.coalesce(F.col(f"{_IN}.head.{name}"), F.lit(0)))
            .when(self._is_tail, F.coalesce(F.col(f"{_IN}.tail.{name}"), F.lit(0)))
            .otherwise(self._local(what, self._whole))
        )

    def first(self) -> Column:
        own = F.first(F.when(F.col(_OWN), F.struct(self.value.alias("v"))), ignorenulls=True).over(self._whole)
        begun = self._is_head & (F.col(f"{_IN}.before.count") > 0)
        return F.when(begun, F.col(f"{_IN}.before.first{self.number}")).otherwise(own["v"])


def _added(a: dict | None, b: dict) -> dict:
    """Totals of two runs of one group, the first of which comes first."""
    if a is None:
        return b
    out = {}
    for name in b:
        if name.startswith("first"):
            out[name] = a[name]
        elif name == "count" or name.startswith("missing"):
            out[name] = a[name] + b[name]
        else:
            out[name] = b[name] if a[name] is None else a[name] if b[name] is None else a[name] + b[name]
    return out


def _carried(parts: list[int], runs: dict[int, list[Row]], facts: Sequence[str]) -> dict[int, tuple]:
    """Per partition: totals of its first group before it, and of its first and last group as a whole.

    ``runs`` has the partition's first and last group, which may be one.
    """
    before, chains, ends, state, key = {}, [], {}, None, None
    for part in parts:
        own = [({n: r[n] for n in facts}, tuple(r["__key"])) for r in runs[part]]
        for k, (totals, name) in enumerate(own):
            goes_on = k == 0 and state is not None and name == key
            if k == 0:
                before[part] = state if goes_on else None
            if not goes_on:
                chains.append(None)
                state = None
            state, key = _added(state, totals), name
            chains[-1] = state
            ends.setdefault(part, []).append(len(chains) - 1)
    return {p: (before[p], chains[ends[p][0]], chains[ends[p][-1]]) for p in parts}


def along(df: DataFrame, order_by: Order, within: Sequence[str] = (), **figures: Figure) -> DataFrame:
    """Add figures along the rows in the given order, or along each group of ``within``."""
    spark = df.sparkSession
    # Figures of one column share its number.
    columns = {id(f.column): f.column for f in figures.values()}
    numbers = {key: i for i, key in enumerate(columns)}
    numbered = [(numbers[id(f.column)], f) for f in figures.values()]
    sums, firsts = ({i for i, f in numbered if wanted(f)} for wanted in (lambda f: f.sums, lambda f: f.firsts))
    rows, order = settled(df, order_by)
    rows = rows.withColumns({f"__x{numbers[key]}": column for key, column in columns.items()})
    placed = PlacedRows(rows, [*within, *order])
    part = F.shiftright(SLOT, PART_SHIFT).alias(_AT)

    # One row per partition and group; kept are the first and last group of a partition.
    facts = [F.count(F.lit(1)).alias("count")]
    facts += [F.count_if(F.col(f"__x{i}").isNull()).alias(f"missing{i}") for i in numbers.values()]
    facts += [F.min_by(f"__x{i}", SLOT).alias(f"first{i}") for i in sorted(firsts)]
    facts += [F.sum(f"__x{i}").alias(f"sum{i}") for i in sorted(sums)]
    names = ["count", *[f"missing{i}" for i in numbers.values()], *[f"first{i}" for i in sorted(firsts)], *[f"sum{i}" for i in sorted(sums)]]
    runs = placed.rows.groupBy(part, *[column_of(k) for k in within]).agg(*facts, F.min(SLOT).alias("from"), F.max(SLOT).alias("to"))
    edge = runs.groupBy(_AT).agg(F.min("from").alias("e_from"), F.max("to").alias("e_to")).withColumnRenamed(_AT, "e_at")
    runs = runs.join(edge, F.col(_AT) == F.col("e_at")).filter((F.col("from") == F.col("e_from")) | (F.col("to") == F.col("e_to")))
    key = F.struct(*key_columns(df, within)) if within else F.struct(F.lit(0))
    kinds = runs.select(*names).schema
    found: dict[int, list[Row]] = {}
    for row in sorted(runs.select(_AT, "from", key.alias("__key"), *names).collect(), key=lambda r: r["from"]):
        found.setdefault(row[_AT], []).append(row)
    carried = _carried(placed.parts, found, names)

    back = max((f.back for _, f in numbered), default=0)
    ends = [*placed.bases[1:], placed.count]
    table = []
    for k, p in enumerate(placed.parts):
        later, j = [], k + 1
        while j < len(placed.parts) and placed.bases[j] - ends[k] < back:
            later.append((placed.parts[j], placed.bases[j]))
            j += 1
        totals = [tuple(t[n] for n in names) if t else None for t in carried[p]]
        table.append((p, placed.bases[k], later, (placed.bases[k], ends[k] - 1, *totals)))
    fields = [T.StructField(n, T.StructType(kinds.fields)) for n in ("before", "head", "tail")]
    carry = T.StructType([T.StructField("first_pos", T.LongType()), T.StructField("last_pos", T.LongType()), *fields])
    later = T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("base", T.LongType())]))
    schema = T.StructType(
        [T.StructField("p", T.LongType()), T.StructField("base", T.LongType()), T.StructField("later", later), T.StructField(_IN, carry)]
    )
    # As many rows as shuffle partitions.
    known = F.broadcast(spark.createDataFrame(table, schema))

    local = F.col(SLOT).bitwiseAND(F.lit((1 << PART_SHIFT) - 1))
    rows = placed.rows.join(known.drop(_IN), F.shiftright(SLOT, PART_SHIFT) == F.col("p")).withColumn(_POS, F.col("base") + local)
    own = F.array(F.struct(F.col("p").alias("at"), F.lit(True).alias("own")))
    if back:
        near = F.filter("later", lambda t: t["base"] - F.col(_POS) <= back)
        own = F.concat(own, F.transform(near, lambda t: F.struct(t["at"].alias("at"), F.lit(False).alias("own"))))
    rows = rows.withColumn("__to", F.explode(own)).withColumns({_AT: F.col("__to.at"), _OWN: F.col("__to.own")})
    rows = rows.drop("p", "base", "later", "__to")
    window = Window.partitionBy(_AT, *[column_of(k) for k in within]).orderBy(_POS)
    longest = {i: max(f.trailing for j, f in numbered if j == i) for i in numbers.values()}
    for i, length in longest.items():
        if length:
            rows = _with_trailing_sums(rows, i, length, window)
    rows = rows.join(known.select("p", _IN), F.col(_AT) == F.col("p"))
    results = {name: f.result(Along(i, window, i in sums)) for (i, f), name in zip(numbered, figures)}
    kept = [column_of(n) for n in df.columns if n not in figures]
    rows = rows.select(*kept, _OWN, *[c.alias(n) for n, c in results.items()])
    return rows.filter(_OWN).drop(_OWN)
