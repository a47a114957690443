"""Choosing, naming and adding columns.

The selection helpers return lists of names, so they combine freely:
``pick(df, between_columns(df, "city", "state"), everything(df))``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

COLUMN_KINDS: dict[str, tuple[type[DataType], ...]] = {
    "text": (StringType,),
    "number": (NumericType,),
    "flag": (BooleanType,),
    "time": (DateType, TimestampType, TimestampNTZType),
}


def quoted(name: str) -> str:
    """A column name that survives dots and spaces."""
    return "`" + name.replace("`", "``") + "`"


def starts_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.lower().startswith(prefix.lower())]


def ends_with(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.lower().endswith(suffix.lower())]


def contains(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part.lower() in c.lower()]


def matches(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name has a match of the regular expression anywhere."""
    return [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]


def num_range(df: DataFrame, prefix: str, numbers: Iterable[int]) -> list[str]:
    return any_of(df, [f"{prefix}{n}" for n in numbers])


def all_of(df: DataFrame, names: Sequence[str]) -> list[str]:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return list(names)


def any_of(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def everything(df: DataFrame) -> list[str]:
    return list(df.columns)


def last_column(df: DataFrame) -> list[str]:
    return df.columns[-1:]


def between_columns(df: DataFrame, first: str, last: str) -> list[str]:
    """Columns from ``first`` to ``last`` by position, both included."""
    all_of(df, [first, last])
    i, j = df.columns.index(first), df.columns.index(last)
    return df.columns[i : j + 1] if i <= j else df.columns[j : i + 1][::-1]


def of_kind(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, COLUMN_KINDS[kind])]


def not_of_kind(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, COLUMN_KINDS[kind])]


def _flat(groups: Iterable[str | Sequence[str]]) -> list[str]:
    names: list[str] = []
    for group in groups:
        names.extend([group] if isinstance(group, str) else group)
    return list(dict.fromkeys(names))


def pick(df: DataFrame, *groups: str | Sequence[str]) -> DataFrame:
    """Keep the named columns, each once, in first-seen order."""
    return df.select(*[quoted(n) for n in _flat(groups)])


def omit(df: DataFrame, *groups: str | Sequence[str]) -> DataFrame:
    dropped = set(_flat(groups))
    return df.select(*[quoted(n) for n in df.columns if n not in dropped])


def move_first(df: DataFrame, *groups: str | Sequence[str]) -> DataFrame:
    return pick(df, *groups, everything(df))


def one_column(df: DataFrame, name: str | None = None) -> DataFrame:
    """The named column, or the last one."""
    return df.select(quoted(name if name is not None else df.columns[-1]))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by ``{old: new}``; an unknown old name is an error."""
    all_of(df, list(names))
    return df.withColumnsRenamed(names)


def set_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def rename_with(
    df: DataFrame, change: Callable[[str], str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rename the given columns (default all) by a function on the name."""
    chosen = set(df.columns if columns is None else all_of(df, columns))
    return df.toDF(*[change(n) if n in chosen else n for n in df.columns])


def clean_names(df: DataFrame) -> DataFrame:
    """Make all names unique, lower-case and underscored."""
    seen: dict[str, int] = {}
    names: list[str] = []
    for name in df.columns:
        clean = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
        clean = re.sub(r"[^0-9a-z]+", "_", clean.lower()).strip("_")
        if not clean or clean[0].isdigit():
            clean = "x" + clean
        unique = clean
        while unique in names:
            seen[clean] = seen.get(clean, 1) + 1
            unique = f"{clean}_{seen[clean]}"
        names.append(unique)
    return df.toDF(*names)


def sentence_name(name: str) -> str:
    """``bikeshop_name`` becomes ``Bikeshop name``."""
    words = name.replace("_", " ")
    return words[:1].upper() + words[1:].lower()


def title_name(name: str) -> str:
    """``sales_avg`` becomes ``Sales Avg``."""
    return " ".join(w[:1].upper() + w[1:].lower() for w in name.replace("_", " ").split(" "))


def add_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns one after the other, so later ones see earlier ones."""
    for name, expression in columns.items():
        df = df.withColumn(name, expression)
    return df


def change_columns(
    df: DataFrame, columns: Sequence[str], change: Callable[[Column], Column]
) -> DataFrame:
    """Apply one expression to several columns, each from its old value."""
    return df.withColumns({n: change(F.col(quoted(n))) for n in columns})


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, missing rows, mean, sd, min, max of numbers, text lengths.

    All figures come from one aggregate over the table.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    entries = []
    for field in fields:
        column = F.col(quoted(field.name))
        number = isinstance(field.dataType, NumericType)
        value = column.cast("double") if number else F.lit(None).cast("double")
        length = F.length(column) if isinstance(field.dataType, StringType) else F.lit(None).cast("int")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.count(F.lit(1)).alias("rows"),
                F.count(F.when(column.isNull(), 1)).alias("missing"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("sd"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                F.min(length).alias("shortest"),
                F.max(length).alias("longest"),
                F.count(F.when(length == 0, 1)).alias("empty"),
            )
        )
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
