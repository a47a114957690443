"""Tables in files: typed CSV and Parquet."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spokewise.operators.columns import quoted
from spokewise.session import freed_shuffles

# Column that holds the raw text of a row with a cell of the wrong type.
BAD_ROW = "_bad_row"
# A compressed file is read by one task, so none gets longer than this.
COMPRESSED_ROWS = 1_000_000


def join_path(folder: str, *parts: str) -> str:
    return posixpath.join(folder, *parts)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    missing: str = "NA",
    keep_bad_rows: bool = False,
    **options: str,
) -> DataFrame:
    """Read CSV files with a header.

    With a schema, a cell of the wrong type becomes NULL; ``keep_bad_rows``
    adds the raw text of such rows for :func:`problems`. Without one, types
    are inferred, which reads the files twice.
    """
    reader = spark.read.options(header=True, nullValue=missing, mode="PERMISSIVE", **options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if keep_bad_rows:
        schema = StructType([*schema.fields, StructField(BAD_ROW, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
    return reader.schema(schema).csv(path)


def problems(df: DataFrame) -> DataFrame:
    """Rows of a CSV read that did not fit the schema, with their raw text.

    The reader judges only the columns a query uses, so the filter uses all of
    them, also when the result is just counted.
    """
    others = [F.col(quoted(c)).cast("string") for c in df.columns if c != BAD_ROW]
    return df.filter(F.col(BAD_ROW).isNotNull() & (F.length(F.concat_ws("", *others)) >= 0))


def write_csv(df: DataFrame, path: str, missing: str = "NA", compression: str | None = None) -> None:
    """Write CSV files with a header, plain or with a ``compression`` that :func:`read_csv` tells by their names."""
    writer = df.write.mode("overwrite").options(header=True, nullValue=missing)
    if compression is not None:
        writer = writer.options(compression=compression, maxRecordsPerFile=COMPRESSED_ROWS)
    writer.csv(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a typed Parquet table; a given schema saves opening a file footer first."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), pieces: int = 1, piece_key: str = "") -> None:
    """Write a typed Parquet table.

    Rows are brought together by partition value, and adaptive execution
    splits a large value over several files.

    With several ``pieces`` the rows are worked out and written one piece after
    the other, dealt by a hash of ``piece_key``, so that disk holds the shuffle
    files of one piece at a time. ``df`` must give the same rows each time it is
    read. The marker of a finished write comes with the last piece.
    """
    with freed_shuffles(df.sparkSession):
        if pieces < 2:
            return _writer(df, partition_by).mode("overwrite").parquet(path)
        # Not the hash by which rows are shuffled: a piece would fill only some of the shuffle partitions.
        piece = F.pmod(F.xxhash64(quoted(piece_key)), F.lit(pieces))
        for k in range(pieces):
            writer = _writer(df.filter(piece == k), partition_by).mode("append" if k else "overwrite")
            writer = writer.option("partitionOverwriteMode", "static")
            writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", k == pieces - 1).parquet(path)


def _writer(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    return df.write.partitionBy(*partition_by)


def refresh_table(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace those partitions of a table for which ``df`` has rows; files of all others stay as they are.

    ``df`` holds the whole new content of these partitions. It is written aside and moved in when all
    tasks are done, so a write that fails leaves the table as it was. A partition without rows in
    ``df`` is kept, not emptied.
    """
    if not partition_by:
        raise ValueError("name the partition columns of the table")
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def list_datasets(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables in a folder, without their file extension."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return sorted(n.removesuffix(".parquet").removesuffix(".csv") for n in names if n[0] not in "._")
