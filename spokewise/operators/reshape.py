"""Long to wide and wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from spokewise.functions.numbers import to_number
from spokewise.functions.text import remove_all
from spokewise.operators.columns import quoted
from spokewise.operators.ordering import column_of


# Name of the column for a missing key.
MISSING_KEY = "<NA>"


def spread(
    df: DataFrame,
    ids: Sequence[str],
    key: str,
    value: str,
    values: Sequence[str] | None = None,
    only_these: bool = False,
) -> DataFrame:
    """One column per key value; a missing cell is NULL, a repeated cell an error.

    Pass the key values where they are known: that saves a job over the table.
    A row whose key is not among them, or is NULL, is an error, unless
    ``only_these`` asks to leave such rows out.
    """
    if values is None:
        limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = [row[0] for row in df.select(column_of(key)).distinct().limit(limit + 1).collect()]
        if len(found) > limit:
            raise ValueError(f"more than {limit} values of {key}")
        missing = None in found
        values = sorted(v for v in found if v is not None)
    else:
        missing = MISSING_KEY in values
    if missing:
        values = [str(v) for v in values if v != MISSING_KEY] + [MISSING_KEY]
        text = F.coalesce(column_of(key).cast("string"), F.lit(MISSING_KEY))
        df = df.withColumn(key, text)
    error = F.raise_error(F.lit(f"more than one row for a value of {key}"))
    content = column_of(value)
    if not only_these:
        # Checked where the cells are filled, so it costs no pass of its own.
        listed = F.coalesce(column_of(key).isin(list(values)), F.lit(False))
        content = F.when(listed, content).otherwise(F.raise_error(F.lit(f"a value of {key} is not listed")))
    cell = F.when(F.count(F.lit(1)) > 1, error).otherwise(F.first(content))
    # The key itself is pivoted, so a table just summed by it is not shuffled again.
    return df.groupBy(*[column_of(c) for c in ids]).pivot(key, list(values)).agg(cell)


def gather(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    key: str = "key",
    value: str = "value",
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """One row per cell of the given columns, or of all but ``ids``; NULL cells stay."""
    if ids is None:
        ids = [c for c in df.columns if c not in (columns or df.columns)]
    if columns is None:
        columns = [c for c in df.columns if c not in ids]
    return df.unpivot(
        [F.col(quoted(c)) for c in ids], [F.col(quoted(c)) for c in columns], key, value
    )


def gather_money(
    df: DataFrame, columns: Sequence[str], key: str = "key", value: str = "value"
) -> DataFrame:
    """Gather columns of money text and turn the text back into numbers."""
    long = gather(df, columns, key, value)
    return long.withColumn(value, to_number(remove_all(F.col(value), r"\$|,")))


def zero_filled_totals(
    df: DataFrame, columns: Sequence[str], name: str = "total_sales"
) -> DataFrame:
    """Replace missing cells of a wide table by 0 and add the row total."""
    filled = df.fillna(0, subset=list(columns))
    row_total = sum((F.col(quoted(c)) for c in columns[1:]), F.col(quoted(columns[0])))
    return filled.withColumn(name, row_total)
