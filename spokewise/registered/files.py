"""Readers and writers, by writing a table to the shared folder and reading it back."""

import uuid

from pyspark.sql import DataFrame, functions as F

from spokewise.plans.sales import SalesTables, export_sales
from spokewise.registered.registry import query, rounded, with_sales
from spokewise.session import shared_folder
from spokewise.sources import cells
from spokewise.sources import files as f


def _folder(t: SalesTables, name: str) -> str:
    return f.join_path(shared_folder(t.spark), f"{name}-{uuid.uuid4().hex}")


@query(
    "csv_round_trip",
    "S2 S9 S10",
    "SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer",
)
def csv_round_trip(t: SalesTables) -> DataFrame:
    path = _folder(t, "customers-csv")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    f.write_csv(t.table("customer").select("c_custkey", "c_name", balance), path)
    return f.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query(
    "csv_problems",
    "S3 S2",
    "SELECT p_partkey, CAST(NULL AS INTEGER) AS p_size, p_partkey || ',n/a' AS bad_row "
    "FROM part WHERE p_size > 25",
)
def csv_problems(t: SalesTables) -> DataFrame:
    path = _folder(t, "sizes-csv")
    size = F.when(F.col("p_size") > 25, "n/a").otherwise(F.col("p_size").cast("string"))
    f.write_csv(t.table("part").select("p_partkey", size.alias("p_size")), path)
    sizes = f.read_csv(t.spark, path, "p_partkey bigint, p_size int", keep_bad_rows=True)
    return f.problems(sizes).withColumnRenamed(f.BAD_ROW, "bad_row")


@query(
    "csv_inferred_types",
    "S1 S2",
    "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice FROM orders",
)
def csv_inferred_types(t: SalesTables) -> DataFrame:
    path = _folder(t, "orders-csv")
    f.write_csv(t.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return f.read_csv(t.spark, path)


@query(
    "csv_guessed_types",
    "S1 S2",
    "SELECT CAST(o_orderkey AS INTEGER) AS order_id, o_orderkey * 10000000000 AS wide_id, "
    "'0' || o_orderkey AS code, o_totalprice AS price, CAST(o_orderdate AS DATE) AS day, "
    "CASE WHEN o_orderkey % 5 > 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) "
    "+ to_seconds(o_orderkey % 86400) END AS placed, "
    "CAST(o_orderkey % 86400 AS INTEGER) AS second_of_day, o_orderkey % 2 = 0 AS is_even, "
    "CAST(NULL AS BOOLEAN) AS nothing, "
    "CASE WHEN o_orderkey = 1 THEN 'first' ELSE CAST(o_orderkey AS VARCHAR) END AS mixed FROM orders",
)
def csv_guessed_types(t: SalesTables) -> DataFrame:
    path = _folder(t, "orders-guess-csv")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    clock = F.date_format(F.timestamp_seconds(key % 86400), "HH:mm:ss")
    placed = F.concat_ws(" ", day.cast("string"), clock)
    orders = t.table("orders").select(
        key.alias("order_id"),
        (key * F.lit(10_000_000_000)).alias("wide_id"),
        F.concat(F.lit("0"), key.cast("string")).alias("code"),
        F.col("o_totalprice").alias("price"),
        day.cast("string").alias("day"),
        F.when(key % 5 > 0, placed).alias("placed"),
        clock.alias("clock"),
        F.when(key % 2 == 0, "T").otherwise("F").alias("is_even"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(key == 1, "first").otherwise(key.cast("string")).alias("mixed"),
    )
    f.write_csv(orders, path)
    guessed = cells.read_guessed(t.spark, path)
    part = lambda unit: F.extract(F.lit(unit), "clock")
    second = part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")
    return guessed.withColumn("second_of_day", second.cast("int")).drop("clock")


@query(
    "csv_cell_problems",
    "S3",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, 'p_size' AS column_name, 'int' AS expected, 'n/a' AS found "
    "FROM part WHERE p_size > 25 "
    "UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_retailprice', 'double', 'dear ' || p_partkey "
    "FROM part WHERE p_partkey % 3 = 0",
)
def csv_cell_problems(t: SalesTables) -> DataFrame:
    path = _folder(t, "cells-csv")
    size = F.when(F.col("p_size") > 25, "n/a").otherwise(F.col("p_size").cast("string"))
    dear = F.concat(F.lit("dear "), F.col("p_partkey").cast("string"))
    price = F.when(F.col("p_partkey") % 3 == 0, dear).otherwise(F.col("p_retailprice").cast("string"))
    f.write_csv(t.table("part").select("p_partkey", size.alias("p_size"), price.alias("p_retailprice")), path)
    schema = "p_partkey bigint, p_size int, p_retailprice double"
    return cells.cell_problems(t.spark, path, schema, keep=["p_partkey"]).drop("file", "row")


@query(
    "snapshot_round_trip",
    "P4 S4 S11 S9",
    with_sales(
        "SELECT order_date, order_id, order_line, quantity, round(total_price, 2) AS total_price, "
        "category_1, city, CAST(year(order_date) AS INTEGER) AS order_year FROM sales"
    ),
)
def snapshot_round_trip(t: SalesTables) -> DataFrame:
    folder = _folder(t, "sales")
    columns = ["order_date", "order_id", "order_line", "quantity", "total_price", "category_1", "city"]
    export_sales(t.sales(*columns), folder)
    back = f.read_table(t.spark, f.join_path(folder, "parquet"))
    return rounded(back.select(*columns, "order_year"), total_price=2)


@query(
    "refreshed_snapshot",
    "S11 S4 P4",
    with_sales(
        "SELECT order_date, order_id, order_line, CASE WHEN year(order_date) = 1997 THEN 2 * quantity ELSE quantity END "
        "AS quantity, CAST(year(order_date) AS INTEGER) AS order_year FROM sales WHERE year(order_date) >= 1995"
    ),
)
def refreshed_snapshot(t: SalesTables) -> DataFrame:
    path = _folder(t, "sales-by-year")
    columns = ["order_date", "order_id", "order_line", "quantity"]
    sales = t.sales(*columns).withColumn("order_year", F.year("order_date"))
    f.write_table(sales, path, ["order_year"])
    changed = sales.filter(F.year("order_date") == 1997).withColumn("quantity", 2 * F.col("quantity"))
    f.refresh_table(changed, path, ["order_year"])
    return f.read_table(t.spark, path, sales.schema).filter(F.col("order_year") >= 1995)


@query(
    "catalog_table",
    "S8",
    "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey "
    "JOIN customer ON c_nationkey = n_nationkey",
)
def catalog_table(t: SalesTables) -> DataFrame:
    for name in ("nation", "region", "customer"):
        t.table(name).createOrReplaceTempView(f"shop_{name}")
    nations, regions = t.spark.table("shop_nation"), t.spark.table("shop_region")
    customers = t.spark.table("shop_customer")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
