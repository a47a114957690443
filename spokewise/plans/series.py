"""Sales over time."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from spokewise.functions.dates import as_date, date_text, floor_date, length_between, month_label
from spokewise.functions.formats import percent_text, with_dollar_text
from spokewise.functions.numbers import to_number
from spokewise.functions.text import separate, unite
from spokewise.operators.aggregates import with_trend
from spokewise.operators import long_series as long
from spokewise.operators.columns import rename_with, title_name
from spokewise.operators.ordering import sort_rows
from spokewise.operators.positions import last_rows
from spokewise.operators.windows import (
    first_value,
    relative_change,
    running_mean,
    running_share,
    running_sum,
    series,
    trailing_mean,
    trailing_median,
    with_change,
)
from spokewise.plans.sales import SalesTables, dollars_by


def yearly_sales(sales: DataFrame) -> DataFrame:
    return dollars_by(sales, F.year("order_date").alias("order_year"))


def monthly_sales(sales: DataFrame) -> DataFrame:
    """Sales per year and month, with the month number and its short name."""
    summed = dollars_by(
        sales, F.year("order_date").alias("order_year"), F.month("order_date").alias("month")
    )
    day = F.make_date("order_year", "month", F.lit(1))
    return summed.select("order_year", "month", month_label(day).alias("order_month"), "sales")


def sales_by_year(sales: DataFrame) -> DataFrame:
    """Yearly sales with money text."""
    return sort_rows(with_dollar_text(yearly_sales(sales), "sales"), "order_year")


def sales_by_year_line(sales: DataFrame) -> DataFrame:
    """Yearly sales with the straight line through all years."""
    return sort_rows(with_trend(yearly_sales(sales), "order_year", "sales"), "order_year")


def sales_by_year_and_category(sales: DataFrame, category: str = "category_2") -> DataFrame:
    """Yearly sales of each category with its straight-line trend."""
    summed = dollars_by(sales, F.year("order_date").alias("order_year"), category)
    return with_dollar_text(with_trend(summed, "order_year", "sales", [category]), "sales")


def yearly_change(sales: DataFrame) -> DataFrame:
    changed = with_change(yearly_sales(sales), "sales", ["order_year"], change="yoy")
    return changed.withColumn("yoy_pct", percent_text(F.col("yoy")))


def yearly_since_first(sales: DataFrame) -> DataFrame:
    value, window = F.col("sales"), series(["order_year"])
    yearly = yearly_sales(sales).withColumn("sales_first", first_value(value, window))
    yearly = yearly.withColumn("increase", relative_change(value, F.col("sales_first")))
    return yearly.withColumn("increase_pct", percent_text(F.col("increase")))


def yearly_running(sales: DataFrame) -> DataFrame:
    value, window = F.col("sales"), series(["order_year"])
    return yearly_sales(sales).withColumns(
        {
            "running_sales": running_sum(value, window),
            "running_mean": running_mean(value, window),
            "running_share": running_share(value, window),
        }
    )


def monthly_change(sales: DataFrame) -> DataFrame:
    """Change from the month before, across year ends."""
    changed = with_change(monthly_sales(sales), "sales", ["order_year", "month"])
    return changed.withColumn("pct_diff_text", percent_text(F.col("pct_diff")))


def monthly_since_first(sales: DataFrame) -> DataFrame:
    """Change since the first month of the same year."""
    value, window = F.col("sales"), series(["month"], within=["order_year"])
    monthly = monthly_sales(sales).withColumn("sales_jan", first_value(value, window))
    monthly = monthly.withColumn("increase", relative_change(value, F.col("sales_jan")))
    return monthly.withColumn("increase_pct", percent_text(F.col("increase")))


def monthly_running(sales: DataFrame) -> DataFrame:
    value, window = F.col("sales"), series(["month"], within=["order_year"])
    monthly = monthly_sales(sales).withColumns(
        {
            "running_sales": running_sum(value, window),
            "running_share": running_share(value, window),
        }
    )
    return monthly.withColumn("running_share_pct", percent_text(F.col("running_share")))


def monthly_rolling(sales: DataFrame, lengths: tuple[int, ...] = (3, 6)) -> DataFrame:
    """Mean of the last months, 0 where there are too few."""
    window = series(["order_year", "month"])
    return monthly_sales(sales).withColumns(
        {f"roll_mean_{k}m": trailing_mean(F.col("sales"), window, k) for k in lengths}
    )


def monthly_rolling_median(sales: DataFrame, length: int = 3) -> DataFrame:
    median = trailing_median(F.col("sales"), series(["order_year", "month"]), length)
    return monthly_sales(sales).withColumn(f"roll_median_{length}m", median)


LINE_ORDER = ("order_date", *SalesTables.LINE_KEY)


def lines_running(sales: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Running total, mean and share of total of all order lines, or of each group's, in order of date."""
    x = F.col("total_price")
    return long.along(
        sales, LINE_ORDER, within, running_sales=long.running_sum(x), running_mean=long.running_mean(x), running_share=long.running_share(x)
    )


def lines_trailing(sales: DataFrame, lengths: tuple[int, ...] = (30, 1000)) -> DataFrame:
    """Each order line with the one before it, the change from it and from the first, and trailing means."""
    x = F.col("total_price")
    found = long.along(
        sales,
        LINE_ORDER,
        sales_lag_1=long.previous(x, fill_self=True),
        sales_lag_7=long.previous(x, 7),
        sales_first=long.first_value(x),
        **{f"roll_mean_{k}": long.trailing_mean(x, k) for k in lengths},
    )
    return found.withColumns({"pct_diff": relative_change(x, F.col("sales_lag_1")), "increase": relative_change(x, F.col("sales_first"))})


def sales_by_calendar_month(sales: DataFrame) -> DataFrame:
    """Sales per month of the year, January first."""
    summed = dollars_by(sales, F.month("order_date").alias("month"))
    label = month_label(F.make_date(F.lit(2000), "month", F.lit(1)))
    labelled = summed.select("month", label.alias("month_label"), "sales")
    return sort_rows(with_dollar_text(labelled, "sales"), "month")


def calendar_month_report(sales: DataFrame) -> DataFrame:
    """The same with text only, under title-case names."""
    rows = sales_by_calendar_month(sales)
    report = rows.select(
        F.col("month").alias("number"), F.col("month_label").alias("month"), F.col("sales_text").alias("sales")
    )
    return rename_with(sort_rows(report, "number").drop("number"), title_name)


def sales_by_month_floor(sales: DataFrame) -> DataFrame:
    return dollars_by(sales, floor_date(F.col("order_date"), "month").alias("order_year_month"))


def sales_by_quarter(sales: DataFrame, category: str = "category_2") -> DataFrame:
    """Revenue per quarter and category."""
    quarter = floor_date(F.col("order_date"), "quarter").alias("order_quarter")
    return dollars_by(sales, category, quarter).withColumnRenamed("sales", "revenue")


def orders_between(sales: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """Rows dated from the first to the last day, both included.

    The bounds are set on the stored timestamp, so they reach the scan.
    """
    after = last + datetime.timedelta(days=1)
    moment = F.col("order_date")
    kind = sales.schema["order_date"].dataType
    start, end = F.lit(first.isoformat()).cast(kind), F.lit(after.isoformat()).cast(kind)
    dated = sales.filter((moment >= start) & (moment < end))
    return dated.withColumn("order_date", as_date(moment))


def last_orders_between(
    sales: DataFrame, first: datetime.date, last: datetime.date, order_by: list[str], count: int = 6
) -> DataFrame:
    return last_rows(orders_between(sales, first, last), order_by, count)


def days_since_order(sales: DataFrame, as_of: datetime.date) -> DataFrame:
    """Days, with fractions, from the order to midnight of a date."""
    end = F.lit(as_of.isoformat()).cast("timestamp_ntz")
    days = length_between(F.col("order_date"), end)
    return sales.withColumns({"as_of": F.lit(as_of), "days_interval": days})


def date_round_trip(sales: DataFrame) -> DataFrame:
    """Split the date text into numbers and put them together again."""
    text = sales.withColumn("order_date", date_text(F.col("order_date")))
    parts = separate(text, "order_date", ["year", "month", "date"], sep="-", remove=False)
    for part in ("year", "month", "date"):
        parts = parts.withColumn(part, to_number(F.col(part), "int"))
    joined = unite(parts, "order_date_united", ["year", "month", "date"], sep="-", remove=False)
    return joined.withColumn("order_date_united", F.col("order_date_united").try_cast("date"))
