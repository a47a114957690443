"""Whole pieces of the sales reports, over all their columns and order lines."""

import datetime
import uuid

from pyspark.sql import DataFrame, functions as F

from spokewise.operators.aggregates import missing_share
from spokewise.operators.columns import clean_names, profile_columns, rename_with
from spokewise.operators.rows import distinct_rows
from spokewise.plans import series as p
from spokewise.plans.sales import SALES_COLUMNS, SalesTables, export_sales
from spokewise.plans.summaries import sales_report_by
from spokewise.registered.registry import YEARLY, as_long, query, rounded, with_sales
from spokewise.session import shared_folder
from spokewise.sources import files as f

_ALL = ", ".join(SALES_COLUMNS)
_MONEY = "'$' || format('{:,.0f}', round(sum(total_price), 2))"
CATEGORIES = {"category_1": "Primary Category", "category_2": "Secondary Category", "frame_material": "Frame Material"}


@query(
    "sales_by_year_line",
    "P2 A18",
    with_sales(
        "SELECT order_year, round(sales, 2) AS sales, round(slope, 2) AS slope, "
        "round((intercept + slope * order_year) / sales, 8) AS fitted_to_sales FROM yearly, "
        "(SELECT regr_slope(sales, order_year) AS slope, regr_intercept(sales, order_year) AS intercept FROM yearly)",
        YEARLY,
    ),
)
def sales_by_year_line(t: SalesTables) -> DataFrame:
    line = as_long(p.sales_by_year_line(t.sales("order_date", "total_price")), "order_year")
    line = line.withColumn("fitted_to_sales", F.col("fitted") / F.col("sales"))
    return rounded(line.drop("fitted", "intercept"), sales=2, slope=2, fitted_to_sales=8)


@query(
    "sales_export",
    "P4 S4 S9 S11",
    with_sales(
        f"SELECT 'csv' AS kind, {_ALL} FROM rounded UNION ALL SELECT 'parquet', {_ALL} FROM rounded",
        "rounded AS (SELECT * REPLACE (round(price, 2) AS price, round(total_price, 2) AS total_price) FROM sales)",
    ),
)
def sales_export(t: SalesTables) -> DataFrame:
    folder = f.join_path(shared_folder(t.spark), f"export-{uuid.uuid4().hex}")
    sales = rounded(t.sales(), price=2, total_price=2)
    export_sales(sales, folder, t.pieces())
    back = {
        "parquet": f.read_table(t.spark, f.join_path(folder, "parquet")).select(*SALES_COLUMNS),
        "csv": f.read_csv(t.spark, f.join_path(folder, "csv"), sales.schema),
    }
    csv, parquet = (df.withColumn("kind", F.lit(kind)) for kind, df in sorted(back.items()))
    return csv.unionByName(parquet)


@query(
    "missing_by_every_column",
    "A13 P7",
    with_sales("SELECT " + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS {c}" for c in SALES_COLUMNS) + " FROM sales"),
)
def missing_by_every_column(t: SalesTables) -> DataFrame:
    return missing_share(t.sales())


_NUMBERS = ("order_id", "order_line", "quantity", "price", "total_price")


def _column_profile(name: str) -> str:
    number, text = name in _NUMBERS, name not in (*_NUMBERS, "order_date")
    value = f"CAST({name} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"
    length = f"CAST(length({name}) AS INTEGER)" if text else "CAST(NULL AS INTEGER)"
    return (
        f"SELECT '{name}' AS \"column\", count(*) AS rows, count(*) - count({name}) AS missing, "
        f"round(avg({value}), 4) AS mean, round(stddev_samp({value}), 4) AS sd, min({value}) AS min, max({value}) AS max, "
        f"min({length}) AS shortest, max({length}) AS longest, count(*) FILTER (WHERE {length} = 0) AS empty FROM sales"
    )


@query("profile_of_every_column", "C25 P7", with_sales(" UNION ALL ".join(map(_column_profile, SALES_COLUMNS))))
def profile_of_every_column(t: SalesTables) -> DataFrame:
    return rounded(profile_columns(t.sales()), mean=4, sd=4)


@query(
    "category_lists",
    "P13 R14",
    with_sales(" UNION ALL ".join(f"SELECT DISTINCT '{c}' AS list, {c} AS value FROM sales" for c in CATEGORIES)),
)
def category_lists(t: SalesTables) -> DataFrame:
    """The values of each of the three categories, in one pass over the order lines."""
    entries = [F.struct(F.lit(c).alias("list"), F.col(c).alias("value")) for c in CATEGORIES]
    return distinct_rows(t.sales(*CATEGORIES).select(F.inline(F.array(*entries))))


def _category_report(column: str, title: str) -> None:
    @query(
        f"sales_report_by_{column}",
        "P14 X1 C15 A2",
        with_sales(f"SELECT {column} AS \"{title}\", {_MONEY} AS \"Sales\" FROM sales GROUP BY 1"),
    )
    def report(t: SalesTables) -> DataFrame:
        return sales_report_by(t.sales(column, "total_price"), column, title)


for _column, _title in CATEGORIES.items():
    _category_report(_column, _title)


@query(
    "last_order_lines_in_range",
    "P20 R9 R11 D5",
    with_sales(
        "SELECT CAST(order_date AS DATE) AS order_date, order_id, order_line, model FROM sales "
        "WHERE order_date >= DATE '1997-01-01' AND order_date < DATE '1999-01-01' "
        "ORDER BY sales.order_date DESC, order_id DESC, order_line DESC, product_id DESC, supplier_id DESC, list_amount DESC LIMIT 6"
    ),
)
def last_order_lines_in_range(t: SalesTables) -> DataFrame:
    products = t.bikes().select(F.col("bike_id").alias("product_id"), "model")
    lines = t.order_lines().join(products, "product_id", "left")
    last = p.last_orders_between(
        lines, datetime.date(1997, 1, 1), datetime.date(1998, 12, 31), ["order_date", *t.LINE_KEY]
    )
    return last.select("order_date", "order_id", "order_line", "model")


@query(
    "days_since_order_line",
    "P21 D14",
    with_sales(
        "SELECT order_id, order_line, product_id, DATE '2002-01-01' AS as_of, "
        "epoch(TIMESTAMP '2002-01-01' - order_date) / 86400 AS days_interval FROM sales"
    ),
)
def days_since_order_line(t: SalesTables) -> DataFrame:
    lines = t.order_lines().select("order_id", "order_line", "product_id", "order_date")
    return p.days_since_order(lines, datetime.date(2002, 1, 1)).drop("order_date")


@query(
    "sales_with_dotted_names",
    "C20 C21 P1",
    with_sales(
        "SELECT order_id, order_line, bikeshop_name, round(total_price, 2) AS total_price FROM sales WHERE city IS NOT NULL"
    ),
)
def sales_with_dotted_names(t: SalesTables) -> DataFrame:
    """Dots for the first underscore of each name, used so, and cleaned again."""
    sales = t.sales("order_id", "order_line", "bikeshop_name", "city", "total_price")
    dotted = rename_with(sales, lambda name: name.replace("_", ".", 1))
    placed = dotted.filter(F.col("city").isNotNull()).drop("city")
    return rounded(clean_names(placed), total_price=2)
