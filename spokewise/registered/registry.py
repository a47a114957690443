"""Where queries are registered, and the SQL text they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from spokewise.plans.sales import SalesTables

TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
FRAMES = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")

LINE_KEY = ", ".join(SalesTables.LINE_KEY)

# The sales table for the SQL twins.
SALES = """sales AS (
  SELECT o_orderdate AS order_date, l_orderkey AS order_id,
    CAST(l_linenumber AS BIGINT) AS order_line, l_quantity AS quantity,
    p_retailprice AS price, l_quantity * p_retailprice AS total_price, p_name AS model,
    p_type AS category_1, split_part(p_name, ' ', 1) AS category_2,
    split_part(p_name, ' ', 2) AS frame_material, c_name AS bikeshop_name,
    n_name AS city, r_name AS state, l_partkey AS product_id, l_suppkey AS supplier_id,
    l_extendedprice AS list_amount
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""
YEARLY = """yearly AS (
  SELECT year(order_date) AS order_year, round(sum(total_price), 4) AS sales
  FROM sales GROUP BY 1)"""
MONTHLY = """monthly AS (
  SELECT year(order_date) AS order_year, month(order_date) AS month,
    strftime(min(order_date), '%b') AS order_month, round(sum(total_price), 4) AS sales
  FROM sales GROUP BY 1, 2)"""


def with_sales(query: str, *more: str) -> str:
    return "WITH " + ",\n".join([SALES, *more]) + "\n" + query


@dataclass(frozen=True)
class Registered:
    build: Callable[[SalesTables], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTERED: dict[str, Registered] = {}


def query(name: str, covers: str, sql: str | None) -> Callable:
    """Register a query under a name, with the inventory IDs it covers."""

    def register(build: Callable[[SalesTables], DataFrame]) -> Callable:
        REGISTERED[name] = Registered(build, sql, tuple(covers.split()))
        return build

    return register


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round double columns, so that both engines give the same digits."""
    return df.withColumns({n: F.round(F.col(n), d) for n, d in digits.items()})


def as_long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


def lines_with_price(t: SalesTables) -> DataFrame:
    """Order lines with their tie-break columns and product price."""
    products = t.bikes().select("bike_id", "model", "price")
    joined = t.lines().join(products, F.col("product_id") == F.col("bike_id"), "left")
    return joined.drop("bike_id").withColumn("total_price", F.col("quantity") * F.col("price"))
