"""Sales over time, and dates."""

import datetime

from pyspark.sql import DataFrame, functions as F

from spokewise.functions import dates as d
from spokewise.functions.formats import with_dollar_text
from spokewise.plans import series as p
from spokewise.plans.sales import SalesTables
from spokewise.registered.registry import LINE_KEY, MONTHLY, YEARLY, as_long, query, rounded, with_sales

# What rounds to zero has no sign.
_PERCENT = "format('{{:,.1f}}%', CASE WHEN abs(100 * {0}) < 0.05 THEN 0.0 ELSE round(100 * {0}, 8) END)"


def _sales(t: SalesTables) -> DataFrame:
    return t.sales("order_date", "total_price")


@query(
    "sales_by_year",
    "P2 J3 A2 A17 D6 X1",
    with_sales(
        "SELECT order_year, round(sales, 2) AS sales, "
        "'$' || format('{:,.0f}', sales) AS sales_text FROM yearly",
        YEARLY,
    ),
)
def sales_by_year(t: SalesTables) -> DataFrame:
    return rounded(as_long(p.sales_by_year(_sales(t)), "order_year"), sales=2)


@query(
    "sales_by_year_category_trend",
    "P3 A3 A18 X1",
    with_sales(
        "SELECT order_year, category_2, round(sales, 2) AS sales, round(slope, 3) AS slope, "
        "round(intercept, -2) AS intercept, "
        "round((intercept + slope * order_year) / sales, 8) AS fitted_to_sales, "
        "'$' || format('{:,.0f}', sales) AS sales_text FROM summed JOIN lines USING (category_2)",
        "summed AS (SELECT year(order_date) AS order_year, category_2, "
        "round(sum(total_price), 4) AS sales FROM sales GROUP BY 1, 2)",
        "lines AS (SELECT category_2, regr_slope(sales, order_year) AS slope, "
        "regr_intercept(sales, order_year) AS intercept FROM summed GROUP BY 1)",
    ),
)
def sales_by_year_category_trend(t: SalesTables) -> DataFrame:
    trend = p.sales_by_year_and_category(t.sales("order_date", "category_2", "total_price"))
    # The ratio is compared, since it has no halves to round.
    trend = trend.withColumn("fitted_to_sales", F.col("fitted") / F.col("sales")).drop("fitted")
    trend = as_long(trend, "order_year")
    return rounded(trend, sales=2, slope=3, intercept=-2, fitted_to_sales=8)


@query(
    "yearly_change",
    "P5 W1 W2 W3 X5",
    with_sales(
        f"""SELECT order_year, round(sales, 2) AS sales, round(prev, 2) AS sales_lag_1,
          round((sales - prev) / prev, 6) AS yoy, {_PERCENT.format('(sales - prev) / prev')} AS yoy_pct
        FROM (SELECT *, coalesce(lag(sales) OVER (ORDER BY order_year), sales) AS prev FROM yearly)""",
        YEARLY,
    ),
)
def yearly_change(t: SalesTables) -> DataFrame:
    changed = as_long(p.yearly_change(_sales(t)), "order_year")
    return rounded(changed, sales=2, sales_lag_1=2, yoy=6)


@query(
    "yearly_since_first",
    "P5 W4 X5",
    with_sales(
        f"""SELECT order_year, round(sales, 2) AS sales, round(f, 2) AS sales_first,
          round((sales - f) / f, 6) AS increase, {_PERCENT.format('(sales - f) / f')} AS increase_pct
        FROM (SELECT *, first_value(sales) OVER (ORDER BY order_year) AS f FROM yearly)""",
        YEARLY,
    ),
)
def yearly_since_first(t: SalesTables) -> DataFrame:
    since = as_long(p.yearly_since_first(_sales(t)), "order_year")
    return rounded(since, sales=2, sales_first=2, increase=6)


@query(
    "yearly_running",
    "P5 W6 W7 W8 A12",
    with_sales(
        """SELECT order_year, round(sales, 2) AS sales,
          round(sum(sales) OVER (ORDER BY order_year), 2) AS running_sales,
          round(avg(sales) OVER (ORDER BY order_year), 4) AS running_mean,
          round(sum(sales) OVER (ORDER BY order_year) / sum(sales) OVER (), 6) AS running_share
        FROM yearly""",
        YEARLY,
    ),
)
def yearly_running(t: SalesTables) -> DataFrame:
    running = as_long(p.yearly_running(_sales(t)), "order_year")
    return rounded(running, sales=2, running_sales=2, running_mean=4, running_share=6)


def _monthly(df: DataFrame, **digits: int) -> DataFrame:
    return rounded(as_long(df, "order_year", "month"), sales=2, **digits)


@query(
    "monthly_change",
    "P6 W1 W2 W3 X5",
    with_sales(
        f"""SELECT order_year, month, order_month, round(sales, 2) AS sales,
          round(prev, 2) AS sales_lag_1, round((sales - prev) / prev, 6) AS pct_diff,
          {_PERCENT.format('(sales - prev) / prev')} AS pct_diff_text
        FROM (SELECT *, coalesce(lag(sales) OVER (ORDER BY order_year, month), sales) AS prev
          FROM monthly)""",
        MONTHLY,
    ),
)
def monthly_change(t: SalesTables) -> DataFrame:
    return _monthly(p.monthly_change(_sales(t)), sales_lag_1=2, pct_diff=6)


@query(
    "monthly_since_jan",
    "P6 W5 X5",
    with_sales(
        f"""SELECT order_year, month, order_month, round(sales, 2) AS sales, round(f, 2) AS sales_jan,
          round((sales - f) / f, 6) AS increase, {_PERCENT.format('(sales - f) / f')} AS increase_pct
        FROM (SELECT *, first_value(sales) OVER (PARTITION BY order_year ORDER BY month) AS f
          FROM monthly)""",
        MONTHLY,
    ),
)
def monthly_since_jan(t: SalesTables) -> DataFrame:
    return _monthly(p.monthly_since_first(_sales(t)), sales_jan=2, increase=6)


@query(
    "monthly_running_share",
    "P6 W6 W8 A12 X5",
    with_sales(
        f"""SELECT order_year, month, order_month, round(sales, 2) AS sales, round(run, 2) AS running_sales,
          round(run / whole, 6) AS running_share, {_PERCENT.format('run / whole')} AS running_share_pct
        FROM (SELECT *, sum(sales) OVER (PARTITION BY order_year ORDER BY month) AS run,
          sum(sales) OVER (PARTITION BY order_year) AS whole FROM monthly)""",
        MONTHLY,
    ),
)
def monthly_running_share(t: SalesTables) -> DataFrame:
    return _monthly(p.monthly_running(_sales(t)), running_sales=2, running_share=6)


def _rolling(function: str, k: int) -> str:
    frame = f"OVER (ORDER BY order_year, month ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"CASE WHEN row_number() OVER (ORDER BY order_year, month) >= {k} "
        f"THEN round({function}(sales) {frame}, 4) ELSE 0.0 END"
    )


@query(
    "monthly_rolling",
    "P6 W9",
    with_sales(
        f"SELECT order_year, month, order_month, round(sales, 2) AS sales, "
        f"{_rolling('avg', 3)} AS roll_mean_3m, {_rolling('avg', 6)} AS roll_mean_6m FROM monthly",
        MONTHLY,
    ),
)
def monthly_rolling(t: SalesTables) -> DataFrame:
    return _monthly(p.monthly_rolling(_sales(t)), roll_mean_3m=4, roll_mean_6m=4)


@query(
    "monthly_rolling_median",
    "W10",
    with_sales(
        f"SELECT order_year, month, order_month, round(sales, 2) AS sales, "
        f"{_rolling('median', 3)} AS roll_median_3m FROM monthly",
        MONTHLY,
    ),
)
def monthly_rolling_median(t: SalesTables) -> DataFrame:
    return _monthly(p.monthly_rolling_median(_sales(t)), roll_median_3m=4)


_LINES = f"{LINE_KEY}, round(total_price, 2) AS total_price"
_ALONG = f"ORDER BY order_date, {LINE_KEY}"
# Means of amounts with one decimal often end in a half; this settles to which side it goes.
_NUDGE = 3.1e-7
_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _running_lines(within: str = "") -> str:
    along = f"({within} {_ALONG} {_SO_FAR})"
    return (
        f"round(sum(total_price) OVER {along}, 2) AS running_sales, round(avg(total_price) OVER {along} + {_NUDGE}, 2) AS running_mean, "
        f"round(sum(total_price) OVER {along} / sum(total_price) OVER ({within}), 6) AS running_share"
    )


def _lines(t: SalesTables, *columns: str) -> DataFrame:
    return t.sales("order_date", *t.LINE_KEY, "total_price", *columns)


@query("lines_running", "W6 W7 W8 A12", with_sales(f"SELECT {_LINES}, {_running_lines()} FROM sales"))
def lines_running(t: SalesTables) -> DataFrame:
    found = as_long(p.lines_running(_lines(t)), "order_line").drop("order_date")
    found = found.withColumn("running_mean", F.col("running_mean") + _NUDGE)
    return rounded(found, total_price=2, running_sales=2, running_mean=2, running_share=6)


@query(
    "lines_running_by_category",
    "W6 W7 W8 A12",
    with_sales(f"SELECT {_LINES}, category_1, {_running_lines('PARTITION BY category_1')} FROM sales"),
)
def lines_running_by_category(t: SalesTables) -> DataFrame:
    found = as_long(p.lines_running(_lines(t, "category_1"), ("category_1",)), "order_line").drop("order_date")
    found = found.withColumn("running_mean", F.col("running_mean") + _NUDGE)
    return rounded(found, total_price=2, running_sales=2, running_mean=2, running_share=6)


def _rolling_lines(k: int) -> str:
    frame = f"({_ALONG} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN row_number() OVER ({_ALONG}) >= {k} THEN round(avg(total_price) OVER {frame}, 6) ELSE 0.0 END AS roll_mean_{k}"


@query(
    "lines_trailing",
    "W1 W2 W3 W4 W9",
    with_sales(
        f"""SELECT {_LINES}, round(prev, 2) AS sales_lag_1, round(seventh, 2) AS sales_lag_7, round(f, 2) AS sales_first,
          round((total_price - prev) / prev, 6) AS pct_diff, round((total_price - f) / f, 6) AS increase, roll_mean_30, roll_mean_1000
        FROM (SELECT *, coalesce(lag(total_price) OVER ({_ALONG}), total_price) AS prev, lag(total_price, 7) OVER ({_ALONG}) AS seventh,
          first_value(total_price) OVER ({_ALONG}) AS f, {_rolling_lines(30)}, {_rolling_lines(1000)} FROM sales)"""
    ),
)
def lines_trailing(t: SalesTables) -> DataFrame:
    found = as_long(p.lines_trailing(_lines(t)), "order_line").drop("order_date")
    return rounded(
        found, total_price=2, sales_lag_1=2, sales_lag_7=2, sales_first=2, pct_diff=6, increase=6, roll_mean_30=6, roll_mean_1000=6
    )


@query(
    "sales_by_calendar_month",
    "P16 A17 O3 D7 D8 X1",
    with_sales(
        "SELECT month(order_date) AS month, strftime(min(order_date), '%b') AS month_label, "
        "round(sum(total_price), 2) AS sales, '$' || format('{:,.0f}', round(sum(total_price), 4)) "
        "AS sales_text FROM sales GROUP BY 1"
    ),
)
def sales_by_calendar_month(t: SalesTables) -> DataFrame:
    return rounded(as_long(p.sales_by_calendar_month(_sales(t)), "month"), sales=2)


@query(
    "calendar_month_report",
    "P16 C17 T3 X1",
    with_sales(
        "SELECT strftime(min(order_date), '%b') AS \"Month\", "
        "'$' || format('{:,.0f}', round(sum(total_price), 4)) AS \"Sales\" "
        "FROM sales GROUP BY month(order_date)"
    ),
)
def calendar_month_report(t: SalesTables) -> DataFrame:
    return p.calendar_month_report(_sales(t))


@query(
    "sales_by_month_floor",
    "A17 D15",
    with_sales(
        "SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_year_month, "
        "round(sum(total_price), 2) AS sales FROM sales GROUP BY 1"
    ),
)
def sales_by_month_floor(t: SalesTables) -> DataFrame:
    return rounded(p.sales_by_month_floor(_sales(t)), sales=2)


@query(
    "sales_by_quarter",
    "P12 A17 D15",
    with_sales(
        "SELECT category_2, CAST(date_trunc('quarter', order_date) AS DATE) AS order_quarter, "
        "round(sum(total_price), 2) AS revenue FROM sales GROUP BY 1, 2"
    ),
)
def sales_by_quarter(t: SalesTables) -> DataFrame:
    return rounded(p.sales_by_quarter(t.sales("order_date", "category_2", "total_price")), revenue=2)


@query(
    "days_since_order",
    "P21 D14",
    "SELECT o_orderkey AS order_id, DATE '2002-01-01' AS as_of, "
    "epoch(TIMESTAMP '2002-01-01' - o_orderdate) / 86400 AS days_interval FROM orders",
)
def days_since_order(t: SalesTables) -> DataFrame:
    orders = t.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date")
    )
    return p.days_since_order(orders, datetime.date(2002, 1, 1)).drop("order_date")


@query(
    "event_intervals",
    "D14",
    "SELECT event_id, (epoch_us(TIMESTAMP '2025-01-01') - epoch_us(ts)) / 864e8 AS days, "
    "(epoch_us(TIMESTAMP '2025-01-01') - epoch_us(ts)) / 6e7 AS minutes FROM events",
)
def event_intervals(t: SalesTables) -> DataFrame:
    end = F.lit("2025-01-01").cast("timestamp_ntz")
    return t.table("events").select(
        "event_id",
        d.length_between(F.col("ts"), end).alias("days"),
        d.length_between(F.col("ts"), end, d.MINUTE).alias("minutes"),
    )


@query(
    "date_parts",
    "D5 D6 D7 D8 D9 D10 D16",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, year(o_orderdate) AS y, "
    "month(o_orderdate) AS m, day(o_orderdate) AS d, strftime(o_orderdate, '%b') AS month_short, "
    "strftime(o_orderdate, '%B') AS month_long, strftime(o_orderdate, '%a') AS weekday, "
    "strftime(o_orderdate, '%Y-%m-%d') AS day_text FROM orders",
)
def date_parts(t: SalesTables) -> DataFrame:
    day = F.col("o_orderdate")
    parts = t.table("orders").select(
        "o_orderkey",
        d.as_date(day).alias("day"),
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.dayofmonth(day).alias("d"),
        d.month_label(day).alias("month_short"),
        d.month_label(day, short=False).alias("month_long"),
        d.weekday_label(day).alias("weekday"),
        d.date_text(day).alias("day_text"),
    )
    return as_long(parts, "y", "m", "d")


@query(
    "parsed_dates",
    "D1 D2 D3 D4 D16",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ymd, CAST(o_orderdate AS DATE) AS mdy_short_year, "
    "CAST(o_orderdate AS DATE) AS mdy_month_name, CAST(o_orderdate AS DATE) AS dmy, "
    "CAST(NULL AS DATE) AS no_date, strftime(o_orderdate, '%Y-%m-%d 06:30:30') AS ymd_hms, "
    "strftime(o_orderdate, '%Y-%m-%d 06:30:30') AS mdy_hms FROM orders",
)
def parsed_dates(t: SalesTables) -> DataFrame:
    def text(layout: str):
        return F.date_format("o_orderdate", layout)

    def shown(moment):
        return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")

    return t.table("orders").select(
        "o_orderkey",
        d.parse_ymd(text("yyyy-M-d")).alias("ymd"),
        d.parse_mdy(text("MM/dd/yy")).alias("mdy_short_year"),
        d.parse_mdy(text("MMMM d yyyy")).alias("mdy_month_name"),
        d.parse_dmy(text("dd.MM.yyyy")).alias("dmy"),
        d.parse_ymd(F.col("o_orderpriority")).alias("no_date"),
        shown(d.parse_ymd_hms(F.concat(text("yyyy-MM-dd"), F.lit(" 06:30:30")))).alias("ymd_hms"),
        shown(d.parse_mdy_hms(F.concat(text("MM/dd/yy"), F.lit(" 06:30:30")))).alias("mdy_hms"),
    )


@query(
    "date_arithmetic",
    "D12 D13",
    "SELECT o_orderkey, CAST(o_orderdate + INTERVAL 12 DAY AS DATE) AS period_end, "
    "strftime(o_orderdate + INTERVAL 288 HOUR, '%Y-%m-%d %H:%M:%S') AS duration_end FROM orders",
)
def date_arithmetic(t: SalesTables) -> DataFrame:
    day = F.col("o_orderdate")
    end = d.add_seconds(day, 12 * d.DAY)
    return t.table("orders").select(
        "o_orderkey",
        d.as_date(d.add_days(day, 12)).alias("period_end"),
        F.date_format(end, "yyyy-MM-dd HH:mm:ss").alias("duration_end"),
    )


@query(
    "orders_until_today",
    "D11",
    "SELECT year(o_orderdate) AS order_year, count(*) AS n FROM orders "
    "WHERE o_orderdate <= current_date AND o_orderdate <= now() GROUP BY 1",
)
def orders_until_today(t: SalesTables) -> DataFrame:
    day = F.col("o_orderdate")
    past = t.table("orders").filter((day <= F.current_date()) & (day <= F.current_timestamp()))
    counted = past.groupBy(F.year(day).alias("order_year")).agg(F.count(F.lit(1)).alias("n"))
    return as_long(counted, "order_year")


@query(
    "date_roundtrip",
    "D16 D17 D1 T15 T16",
    "SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date, "
    "CAST(o_orderdate AS DATE) AS order_date_united, CAST(year(o_orderdate) AS INTEGER) AS year, "
    "CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS date FROM orders",
)
def date_roundtrip(t: SalesTables) -> DataFrame:
    return p.date_round_trip(
        t.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date")
        )
    )


@query(
    "yearly_millions",
    "X3 X4",
    with_sales(
        "SELECT order_year, '$' || format('{:,.2f}', round(sales / 1e6, 9)) || 'M' AS sales_text "
        "FROM yearly",
        YEARLY,
    ),
)
def yearly_millions(t: SalesTables) -> DataFrame:
    yearly = as_long(p.yearly_sales(_sales(t)), "order_year")
    return with_dollar_text(yearly, "sales", scale=1 / 1e6, suffix="M").drop("sales")
