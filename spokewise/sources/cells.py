"""Cells of text files: types guessed from all of them, and those that do not fit a declared type.

Both work on a text read of the files, where every column is a string.

A cell fits a set of kinds, written as bits; what fits a narrow kind also fits the wider ones. The
bits of a column are the ``bit_and`` over its cells, so one aggregate over one scan judges all columns,
with partial results per task. The kind of a column is the narrowest left:

boolean (``T F TRUE FALSE true false``), int, bigint, double, date (year first), timestamp without
zone, timestamp with zone, time of day (as the interval since midnight), string.

Numbers with leading zeros are text, as they are mostly keys. A column without any cell is boolean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spokewise.operators.columns import quoted

# Column that holds the raw text of a record with too few or too many cells.
MISCUT = "_miscut"

TIME_TYPE = "interval day to second"
KINDS = ("boolean", "int", "bigint", "double", "date", "timestamp_ntz", "timestamp", TIME_TYPE, "string")
_BIT = {kind: 1 << place for place, kind in enumerate(KINDS)}

# The form of the cells of each kind.
_LOGICAL = "^(T|F|TRUE|FALSE|true|false)$"
_INTEGER = "^[+-]?(0|[1-9][0-9]*)$"
_DOUBLE = "^[+-]?((0|[1-9][0-9]*)([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$|^NaN$|^[+-]?Inf$"
_DATE = "^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}$"
_MOMENT = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?"
_LOCAL = _MOMENT + "$"
_ZONED = _MOMENT + " ?(Z|[+-][0-9]{2}:[0-9]{2})$"
_TIME = "^([01]?[0-9]|2[0-3]):([0-5][0-9])(?::([0-5][0-9](?:[.][0-9]+)?))?$"


def read_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None, missing: str = "NA", **options: str) -> DataFrame:
    """All columns of CSV files with a header as text, missing cells as NULL.

    With ``columns`` the names are given by place, without a look into the files, and a further
    column ``_miscut`` has the raw text of records with another number of cells.
    """
    reader = spark.read.options(header=True, nullValue=missing, mode="PERMISSIVE", **options)
    if columns is None:
        return reader.csv(path)
    fields = [StructField(c, StringType()) for c in [*columns, MISCUT]]
    return reader.option("columnNameOfCorruptRecord", MISCUT).schema(StructType(fields)).csv(path)


def to_kind(cell: Column, kind: str) -> Column:
    """A text cell as a value of the kind, NULL if it is none."""
    if kind == "boolean":
        return F.when(cell.rlike(_LOGICAL), F.upper(F.substring(cell, 1, 1)) == "T")
    if kind == "date":
        return F.when(cell.rlike(_DATE), F.regexp_replace(cell, "/", "-").try_cast("date"))
    if kind == TIME_TYPE:
        part = lambda k: F.regexp_extract(cell, _TIME, k)
        seconds = F.when(part(3) == "", "0").otherwise(part(3)).cast("decimal(18,6)")
        value = F.make_dt_interval(F.lit(0), part(1).cast("int"), part(2).cast("int"), seconds)
        return F.when(cell.rlike(_TIME), value)
    forms = {"int": _INTEGER, "bigint": _INTEGER, "double": _DOUBLE, "timestamp_ntz": _LOCAL, "timestamp": _ZONED}
    return F.when(cell.rlike(forms[kind]), cell.try_cast(kind)) if kind in forms else cell


def _fits(cell: Column) -> Column:
    """Bits of all kinds a cell fits, NULL for a missing cell.

    The forms exclude each other, but for whole numbers, which are doubles, too. So the first one that
    holds decides. A cast that overflows costs as much as ten regular expressions, so a whole number is
    cast where it cannot, and compared with the bounds.
    """
    fits = lambda kind: to_kind(cell, kind).isNotNull()
    bits = lambda *kinds: F.lit(sum(_BIT[k] for k in (*kinds, "string")))
    short = F.when(F.length(cell) <= 19, cell.try_cast("bigint"))
    long = F.when(F.length(cell) <= 23, cell.try_cast("decimal(38,0)"))
    whole = F.when(short.between(-(1 << 31), (1 << 31) - 1), bits("int", "bigint", "double"))
    whole = whole.when(short.isNotNull() | long.between(-(1 << 63), (1 << 63) - 1), bits("bigint", "double"))
    whole = whole.when(cell.try_cast("double").isNotNull(), bits("double")).otherwise(bits())
    # A text of the form of a time of day is one.
    clock = F.when(cell.rlike(_TIME), bits(TIME_TYPE)).when(fits("timestamp_ntz"), bits("timestamp_ntz"))
    clock = clock.when(fits("timestamp"), bits("timestamp")).otherwise(bits())
    plain = F.when(cell.rlike(_INTEGER), whole).when(fits("date"), bits("date")).when(fits("double"), bits("double"))
    plain = plain.when(cell.rlike(_LOGICAL), bits("boolean")).otherwise(bits())
    # Only times of day and moments have a colon, and all of them do.
    return F.when(cell.isNotNull(), F.when(cell.contains(":"), clock).otherwise(plain))


def guess_types(text: DataFrame) -> dict[str, str]:
    """Name and type of each column of a text table, judged by all of its cells in one scan.

    Rows are unfolded to cells, so that the code that judges one is the same small piece for any number of
    columns. A task hands on the different bits of each column, of which there are a dozen at most.
    """
    if not text.columns:
        return {}
    cells = text.select(F.posexplode(F.array(*[F.col(quoted(c)) for c in text.columns])).alias("place", "cell"))
    found = cells.filter(F.col("cell").isNotNull()).select("place", _fits(F.col("cell")).alias("bits")).distinct()
    left = {r.place: r.bits for r in found.groupBy("place").agg(F.bit_and("bits").alias("bits")).collect()}
    narrowest = lambda bits: KINDS[0] if bits is None else next(k for k in KINDS if bits & _BIT[k])
    return {c: narrowest(left.get(k)) for k, c in enumerate(text.columns)}


def with_types(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """The text table with its columns turned into the given kinds."""
    return text.select(*[to_kind(F.col(quoted(c)), types[c]).alias(c) if c in types else F.col(quoted(c)) for c in text.columns])


def read_guessed(spark: SparkSession, path: str, missing: str = "NA", **options: str) -> DataFrame:
    """CSV files with a header, typed by what all of their cells fit."""
    text = read_text(spark, path, missing=missing, **options)
    return with_types(text, guess_types(text))


def numbered_records(text: DataFrame) -> DataFrame:
    """The table with ``_file`` and ``_record``, the place of a record in its file from one on.

    ``text`` is what a reader returned. Header and blank lines do not count. A file is read in blocks,
    each by one task and in order. One aggregate gives the records of each block; only this table,
    with one row per block, is summed along the file.
    """
    rows = text.select(
        *[F.col(quoted(c)) for c in text.columns],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
    )
    blocks = rows.groupBy("_file", "_block").agg(F.min("_place").alias("_first"), F.count("*").alias("_count"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("_file").alias("_b_file"),
        F.col("_block").alias("_b_block"),
        (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    found = rows.join(blocks, (F.col("_file") == F.col("_b_file")) & (F.col("_block") == F.col("_b_block")))
    return found.select(*[F.col(quoted(c)) for c in text.columns], "_file", (F.col("_place") + F.col("_shift")).alias("_record"))


def cell_problems(spark: SparkSession, path: str, schema: StructType | str, missing: str = "NA", keep: Sequence[str] = (), **options: str) -> DataFrame:
    """One row per cell that does not fit its declared type: file, row, column_name, expected, found.

    A cell fits if its text can be cast. A record with another number of cells gives one more row,
    without a column name, with its raw text. ``keep`` names columns to carry along as text.
    ``row`` is the place of the record in its file, from one on.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    text = read_text(spark, path, schema.names, missing, **options)
    row = lambda name, expected, found: F.struct(
        F.lit(name).cast("string").alias("column_name"), F.lit(expected).alias("expected"), found.alias("found")
    )
    checks = [F.when(F.col(MISCUT).isNotNull(), row(None, f"{len(schema)} columns", F.col(MISCUT)))]
    for field in schema:
        cell, kind = F.col(quoted(field.name)), field.dataType
        if not isinstance(kind, StringType):
            misfit = cell.isNotNull() & cell.try_cast(kind).isNull()
            checks.append(F.when(misfit, row(field.name, kind.simpleString(), cell)))
    records = numbered_records(text).withColumn("_bad", F.filter(F.array(*checks), lambda c: c.isNotNull()))
    bad = records.filter(F.size("_bad") > 0)
    carried = [F.col(quoted(c)) for c in keep]
    return bad.select(F.col("_file").alias("file"), F.col("_record").alias("row"), *carried, F.inline("_bad"))
