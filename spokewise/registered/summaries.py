"""Grouped and whole-table summaries."""

from pyspark.sql import DataFrame, functions as F

from spokewise.functions.numbers import to_number
from spokewise.operators import aggregates as a
from spokewise.operators.ordering import sort_rows
from spokewise.plans.products import (
    base_model_price_report,
    model_features,
    model_type,
    price_bands,
    price_by_base_model,
    price_scales,
)
from spokewise.plans.sales import SalesTables
from spokewise.plans.summaries import (
    median_by_attributes,
    median_report,
    missing_profile,
    price_statistics,
    revenue_by_groups,
    sales_report_by,
)
from spokewise.registered.registry import (
    LINE_KEY,
    lines_with_price,
    query,
    rounded,
    with_sales,
)

_ORDER = list(SalesTables.LINE_KEY)


@query("total_revenue", "A1", with_sales("SELECT round(sum(total_price), 2) AS revenue FROM sales"))
def total_revenue(t: SalesTables) -> DataFrame:
    s = t.sales("total_price")
    return a.summarise(s, revenue=F.round(a.total(F.col("total_price")), 2))


@query(
    "revenue_by_trio",
    "A3 A4 P7 O2",
    with_sales(
        "SELECT category_1, category_2, frame_material, round(sum(total_price), 2) AS revenue "
        "FROM sales GROUP BY ALL"
    ),
)
def revenue_by_trio(t: SalesTables) -> DataFrame:
    s = t.sales("category_1", "category_2", "frame_material", "total_price")
    return rounded(revenue_by_groups(s), revenue=2)


@query(
    "six_stats",
    "A5 A6 A7 A8 A9 A10 A16 P7",
    with_sales(
        "SELECT category_1, category_2, count(*) AS count, round(avg(total_price), 4) AS avg_total_price, "
        "round(median(total_price), 4) AS median_total_price, "
        "round(stddev_samp(total_price), 4) AS sd_total_price, "
        "round(min(total_price), 4) AS min_total_price, round(max(total_price), 4) AS max_total_price "
        "FROM sales GROUP BY ALL"
    ),
)
def six_stats(t: SalesTables) -> DataFrame:
    stats = price_statistics(t.sales("category_1", "category_2", "total_price"))
    names = [c for c in stats.columns if c.endswith("_total_price")]
    return rounded(stats, **{n: 4 for n in names})


@query(
    "strict_and_lenient_statistics",
    "A6 A7 A8 A9 A10",
    """WITH b AS (SELECT c_mktsegment, nullif(c_acctbal, (SELECT max(c_acctbal) FROM customer)) AS x
      FROM customer)
    SELECT c_mktsegment, CASE WHEN count(x) = count(*) THEN round(sum(x), 2) END AS strict_sum,
      CASE WHEN count(x) = count(*) THEN round(median(x), 4) END AS strict_median,
      CASE WHEN count(x) = count(*) THEN round(stddev_samp(x), 4) END AS strict_sd,
      CASE WHEN count(x) = count(*) THEN max(x) END AS strict_max,
      round(sum(x), 2) AS lenient_sum, round(median(x), 4) AS lenient_median, max(x) AS lenient_max
    FROM b GROUP BY 1""",
)
def strict_and_lenient_statistics(t: SalesTables) -> DataFrame:
    customers = t.table("customer").select("c_mktsegment", "c_acctbal")
    largest = customers.agg(F.max("c_acctbal")).scalar()
    x = F.col("x")
    blanked = customers.select("c_mktsegment", F.nullif(F.col("c_acctbal"), largest).alias("x"))
    facts = a.summarise(
        blanked,
        ["c_mktsegment"],
        strict_sum=F.round(a.total(x), 2),
        strict_sd=F.round(a.deviation(x), 4),
        strict_max=a.maximum(x),
        lenient_sum=F.round(a.total(x, na_rm=True), 2),
        lenient_max=a.maximum(x, na_rm=True),
    )
    medians = a.medians(blanked, ["c_mktsegment"], "x", "strict_median")
    lenient = a.medians(blanked, ["c_mktsegment"], "x", "lenient_median", na_rm=True)
    joined = a.with_group_facts(a.with_group_facts(facts, medians, ["c_mktsegment"]), lenient, ["c_mktsegment"])
    return rounded(joined, strict_median=4, lenient_median=4)


@query(
    "null_ratio",
    "A13 R15 R8 P7",
    with_sales(
        "SELECT round(avg(CASE WHEN order_id IS NULL THEN 1.0 ELSE 0 END), 9) AS order_id, "
        "round(avg(CASE WHEN quantity IS NULL THEN 1.0 ELSE 0 END), 9) AS quantity, "
        "round(avg(CASE WHEN rn <= 4 OR total_price IS NULL THEN 1.0 ELSE 0 END), 9) AS total_price "
        "FROM numbered",
        f"numbered AS (SELECT *, row_number() OVER (ORDER BY {LINE_KEY}) AS rn FROM sales)",
    ),
)
def null_ratio(t: SalesTables) -> DataFrame:
    profile = missing_profile(lines_with_price(t), _ORDER)
    return rounded(
        profile.select("order_id", "quantity", "total_price"), order_id=9, quantity=9, total_price=9
    )


@query(
    "price_band",
    "M10 A11 M7 P9 F9",
    with_sales(
        f"SELECT {LINE_KEY}, round(total_price, 2) AS total_price, "
        "CASE WHEN total_price > (SELECT quantile_cont(total_price, 0.75) FROM sales) THEN 'High' "
        "WHEN total_price > (SELECT quantile_cont(total_price, 0.25) FROM sales) THEN 'Medium' "
        "ELSE 'low' END AS total_price_cat FROM sales"
    ),
)
def price_band(t: SalesTables) -> DataFrame:
    priced = lines_with_price(t).select(*_ORDER, "total_price")
    return rounded(price_bands(priced), total_price=2)


@query(
    "quantiles_by_category",
    "A11",
    with_sales(
        "SELECT category_1, round(quantile_cont(total_price, 0.1), 4) AS q10, "
        "round(quantile_cont(total_price, 0.5), 4) AS q50, "
        "round(quantile_cont(total_price, 0.95), 4) AS q95 FROM sales GROUP BY 1"
    ),
)
def quantiles_by_category(t: SalesTables) -> DataFrame:
    s = t.sales("category_1", "total_price")
    marks = a.quantiles(s, ["category_1"], "total_price", {"q10": 0.1, "q50": 0.5, "q95": 0.95})
    return rounded(marks, q10=4, q50=4, q95=4)


@query(
    "boxplot_stats",
    "A19",
    with_sales(
        """SELECT category_1, round(min(total_price), 4) AS least, round(any_value(q1), 4) AS q1,
          round(any_value(mid), 4) AS median, round(any_value(q3), 4) AS q3,
          round(max(total_price), 4) AS greatest,
          round(min(total_price) FILTER (WHERE total_price >= q1 - 1.5 * (q3 - q1)), 4) AS whisker_low,
          round(max(total_price) FILTER (WHERE total_price <= q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
          count(*) FILTER (WHERE total_price < q1 - 1.5 * (q3 - q1)
            OR total_price > q3 + 1.5 * (q3 - q1)) AS outliers
        FROM sales JOIN marks USING (category_1) GROUP BY 1""",
        """marks AS (SELECT category_1, quantile_cont(total_price, 0.25) AS q1,
          quantile_cont(total_price, 0.5) AS mid, quantile_cont(total_price, 0.75) AS q3
        FROM sales GROUP BY 1)""",
    ),
)
def boxplot_stats(t: SalesTables) -> DataFrame:
    box = a.box_statistics(t.sales("category_1", "total_price"), ["category_1"], "total_price")
    names = [c for c in box.columns if c not in ("category_1", "outliers")]
    return rounded(box, **{n: 4 for n in names})


@query(
    "median_by_attribute",
    "P17 A14 A7 T1",
    with_sales(
        " UNION ALL ".join(
            f"SELECT '{w}' AS word, regexp_matches(lower(model), '{w}') AS has_word, "
            "round(median(total_price), 4) AS sales_median FROM sales GROUP BY 2"
            for w in ("red", "plate", "hot")
        )
    ),
)
def medians_by_attribute(t: SalesTables) -> DataFrame:
    medians = median_by_attributes(t.sales("model", "total_price"), ["red", "plate", "hot"])
    return rounded(medians, sales_median=4)


@query(
    "median_report",
    "P17 X2 C15",
    with_sales(
        "SELECT regexp_matches(lower(model), 'plate') AS \"Plate\", "
        "'$' || format('{:,.0f}', round(median(total_price), 2)) AS \"Median Sales\" "
        "FROM sales GROUP BY 1"
    ),
)
def plate_median_report(t: SalesTables) -> DataFrame:
    return median_report(t.sales("model", "total_price"), "plate", "Plate")


@query(
    "sales_report_by_category",
    "P14 X1 C15 A2",
    with_sales(
        "SELECT category_2 AS \"Secondary Category\", "
        "'$' || format('{:,.0f}', round(sum(total_price), 2)) AS \"Sales\" FROM sales GROUP BY 1"
    ),
)
def sales_report_by_category(t: SalesTables) -> DataFrame:
    return sales_report_by(
        t.sales("category_2", "total_price"), "category_2", "Secondary Category"
    )


@query(
    "trend_by_category",
    "A18",
    with_sales(
        "SELECT category_1, round(regr_slope(total_price, quantity), 4) AS slope, "
        "round(regr_intercept(total_price, quantity), 2) AS intercept FROM sales GROUP BY 1"
    ),
)
def trend_by_category(t: SalesTables) -> DataFrame:
    trend = a.linear_trend(
        t.sales("category_1", "quantity", "total_price"), "quantity", "total_price", ["category_1"]
    )
    return rounded(trend, slope=4, intercept=2)


@query(
    "log_sqrt",
    "M2 M3 P9",
    with_sales(
        f"SELECT {LINE_KEY}, round(ln(total_price), 8) AS total_price_log, "
        "round(sqrt(total_price), 8) AS total_price_sqrt FROM sales"
    ),
)
def log_sqrt(t: SalesTables) -> DataFrame:
    scaled = price_scales(lines_with_price(t)).select(*_ORDER, "total_price_log", "total_price_sqrt")
    return rounded(scaled, total_price_log=8, total_price_sqrt=8)


@query(
    "model_type",
    "M7 P9",
    with_sales(
        "SELECT order_id, order_line, CASE WHEN lower(model) LIKE '%ring%' THEN 'Ring' "
        "WHEN lower(model) LIKE '%gear%' THEN 'Gear' ELSE 'Neither Ring nor Gear' END AS bike_type "
        "FROM sales"
    ),
)
def model_types(t: SalesTables) -> DataFrame:
    typed = model_type(
        t.sales("order_id", "order_line", "model"),
        {"ring": "Ring", "gear": "Gear"},
        "Neither Ring nor Gear",
    )
    return typed.drop("model")


# The rules, carried over to the two-word model names of the part table.
REPAIRS = {f"{word} gizmo": f"{word} gadget" for word in ("blue", "cold", "hot", "large", "new", "old", "red", "small")}
RULES = ((2, "ring", 2), (2, "rod", 2))
FLAGS = {"anvil": "anvil", "gadget": "gadget", "plate": "plate", "widget": "widget"}

_FEATURES = """featured AS (
  SELECT *, CASE WHEN word_2 IN ('ring', 'rod') THEN model ELSE word_1 END AS base_model,
    CASE WHEN word_2 IN ('ring', 'rod') THEN '' ELSE word_2 END AS model_tier
  FROM (SELECT p_partkey AS bike_id, p_type AS category_1, split_part(p_name, ' ', 1) AS category_2,
    p_retailprice AS price, replace(p_name, 'gizmo', 'gadget') AS model,
    split_part(p_name, ' ', 1) AS word_1,
    replace(split_part(p_name, ' ', 2), 'gizmo', 'gadget') AS word_2 FROM part))"""


@query(
    "model_features",
    "P10 M5 M9 T11 T15 T17",
    f"WITH {_FEATURES} SELECT bike_id, model, base_model, model_tier, "
    + ", ".join(f"CAST(model_tier LIKE '%{w}%' AS INTEGER) AS {n}" for n, w in FLAGS.items())
    + " FROM featured",
)
def part_model_features(t: SalesTables) -> DataFrame:
    return model_features(t.bikes().select("bike_id", "model"), REPAIRS, RULES, FLAGS)


@query(
    "price_by_base_model",
    "P18 A3 A6 A9 A10",
    f"""WITH {_FEATURES}, sold AS (
      SELECT DISTINCT category_1, category_2, model, base_model, price FROM featured
      WHERE bike_id IN (SELECT l_partkey FROM lineitem))
    SELECT category_1, category_2, base_model, round(avg(price), 4) AS sales_avg,
      min(price) AS sales_min, max(price) AS sales_max FROM sold GROUP BY ALL""",
)
def part_price_by_base_model(t: SalesTables) -> DataFrame:
    s = t.sales("category_1", "category_2", "model", "price")
    return rounded(price_by_base_model(s, REPAIRS, RULES), sales_avg=4)


@query(
    "price_by_base_model_report",
    "P18 C23 C17 X2",
    with_sales(
        """SELECT category_1 AS "Category 1", category_2 AS "Category 2", base_model AS "Base Model",
          '$' || format('{:,.0f}', round(avg(price), 6)) AS "Sales Avg",
          '$' || format('{:,.0f}', min(price)) AS "Sales Min",
          '$' || format('{:,.0f}', max(price)) AS "Sales Max"
        FROM (SELECT *, CASE WHEN frame_material IN ('ring', 'rod') THEN model ELSE category_2 END
          AS base_model FROM sales) GROUP BY category_1, category_2, base_model"""
    ),
)
def part_price_report(t: SalesTables) -> DataFrame:
    s = t.sales("category_1", "category_2", "model", "price")
    prices = price_by_base_model(s, REPAIRS, RULES, distinct=False)
    return base_model_price_report(rounded(prices, sales_avg=6))


@query(
    "text_to_number",
    "M4 M6",
    "SELECT p_partkey, try_cast(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand_number, "
    "CAST(NULL AS DOUBLE) AS not_a_number, CAST(p_size AS VARCHAR) AS size_text FROM part",
)
def text_to_number(t: SalesTables) -> DataFrame:
    return t.table("part").select(
        "p_partkey",
        to_number(F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("brand_number"),
        to_number(F.col("p_brand")).alias("not_a_number"),
        F.col("p_size").cast("string").alias("size_text"),
    )


@query(
    "sorted_statistics",
    "A2 O1",
    "SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) AS quantity "
    "FROM lineitem GROUP BY 1 ORDER BY 1",
)
def sorted_statistics(t: SalesTables) -> DataFrame:
    summed = a.summarise(
        t.table("lineitem"),
        ["l_returnflag"],
        n=F.count(F.lit(1)),
        quantity=F.round(a.total(F.col("l_quantity")), 2),
    )
    return sort_rows(summed, "l_returnflag")
