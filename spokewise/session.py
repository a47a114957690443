"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key over several tasks, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_folders: dict[str, str] = {}


def build_session(app: str = "spokewise", master: str | None = None, **settings: str) -> SparkSession:
    """Return a session with the settings the library expects.

    Keyword names use ``__`` for the dots of a Spark setting
    (``spark__sql__shuffle__partitions="8"``).
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="spokewise-")
    return _local_folders[app]


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query as it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


# Tables staged inside each open ``staging`` block, innermost last.
_open_blocks: list[list[tuple[str, StructType]]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Free what is staged inside the block when it ends, also on an error.

    Results of the block must have been written or collected by then. Each table
    is overwritten by an empty one, which every file system allows.
    """
    _open_blocks.append([])
    try:
        yield
    finally:
        for path, schema in _open_blocks.pop():
            spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Used where two later steps must see the very same rows, also after an
    executor is lost. The table stays until the ``staging`` block around it
    ends, or else until the shared folder is emptied.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for block in _open_blocks[-1:]:
        block.append((path, df.schema))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
