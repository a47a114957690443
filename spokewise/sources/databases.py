"""Tables in a JDBC database. Nothing is fetched before an action."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


@dataclass(frozen=True)
class Database:
    """Where a database is. Each task opens and closes its own connection."""

    url: str
    driver: str
    options: dict[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.options}


@dataclass(frozen=True)
class ReadRange:
    """Number column and bounds by which a table is read in parallel."""

    column: str
    lower: int
    upper: int
    partitions: int

    def settings(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def read_database_table(
    spark: SparkSession, database: Database, table: str, by: ReadRange | None = None
) -> DataFrame:
    """A lazy table; filters and column choice run in the database."""
    options = {**database.settings(), "dbtable": table, **(by.settings() if by else {})}
    return spark.read.format("jdbc").options(**options).load()


def register_database(spark: SparkSession, name: str, database: Database) -> None:
    """Make the database a catalog, so its tables read as ``spark.table("name.schema.table")``."""
    spark.conf.set(f"spark.sql.catalog.{name}", _JDBC_CATALOG)
    for key, value in database.settings().items():
        spark.conf.set(f"spark.sql.catalog.{name}.{key}", value)


def list_tables(spark: SparkSession, namespace: str | None = None) -> list[str]:
    """Names of the tables and views in a catalog namespace, by default the current one."""
    where = f" IN {namespace}" if namespace else ""
    return sorted(row["tableName"] for row in spark.sql(f"SHOW TABLES{where}").collect())
