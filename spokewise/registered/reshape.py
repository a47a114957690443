"""Long and wide tables."""

from pyspark.sql import DataFrame, functions as F

from spokewise.operators import reshape as r
from spokewise.operators.ordering import sort_rows
from spokewise.plans import summaries as p
from spokewise.plans.sales import SalesTables
from spokewise.registered.registry import FRAMES, TYPES, query, rounded, with_sales

_CELL = "sum(total_price) FILTER (WHERE {0} = '{1}')"
_WIDE = ", ".join(f'round({_CELL.format("category_1", c)}, 2) AS "{c}"' for c in TYPES)


def _sales(t: SalesTables) -> DataFrame:
    return t.sales("bikeshop_name", "category_1", "total_price")


@query(
    "shop_category_wide",
    "P8 G1 O4",
    with_sales(f"SELECT bikeshop_name, {_WIDE} FROM sales GROUP BY 1"),
)
def shop_category_wide(t: SalesTables) -> DataFrame:
    return rounded(p.shop_revenue_wide(_sales(t), TYPES), **{c: 2 for c in TYPES})


@query(
    "shop_category_long",
    "P8 G2",
    with_sales(
        """SELECT bikeshop_name, category_1, round(sum(total_price), 2) AS sales
        FROM (SELECT DISTINCT bikeshop_name FROM sales)
        CROSS JOIN (SELECT DISTINCT category_1 FROM sales)
        LEFT JOIN sales USING (bikeshop_name, category_1) GROUP BY 1, 2"""
    ),
)
def shop_category_long(t: SalesTables) -> DataFrame:
    return rounded(p.shop_revenue_long(_sales(t), TYPES), sales=2)


_MONEY = ", ".join(
    f"""'$' || format('{{:,.0f}}', round({_CELL.format("category_1", c)}, 4)) AS "{c}\""""
    for c in TYPES
)


@query(
    "shop_category_report",
    "P8 G1 X1 C17",
    with_sales(f'SELECT bikeshop_name AS "Bikeshop name", {_MONEY} FROM sales GROUP BY 1'),
)
def shop_category_report(t: SalesTables) -> DataFrame:
    return p.shop_revenue_report(_sales(t), TYPES)


@query(
    "shop_category_money_long",
    "P8 G4 T13 M4",
    with_sales(
        """SELECT bikeshop_name AS "Bikeshop name", category_1, CAST(replace(format('{:,.0f}',
          round(sum(total_price), 4)), ',', '') AS DOUBLE) AS sales
        FROM (SELECT DISTINCT bikeshop_name FROM sales)
        CROSS JOIN (SELECT DISTINCT category_1 FROM sales)
        LEFT JOIN sales USING (bikeshop_name, category_1) GROUP BY 1, 2"""
    ),
)
def shop_category_money_long(t: SalesTables) -> DataFrame:
    return p.shop_report_to_long(p.shop_revenue_report(_sales(t), TYPES), TYPES)


@query(
    "gather_by_exclusion",
    "G2",
    " UNION ALL ".join(
        f"SELECT o_orderkey, '{c}' AS field, {c} AS value FROM orders"
        for c in ("o_orderstatus", "o_orderpriority")
    ),
)
def gather_by_exclusion(t: SalesTables) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return r.gather(orders, key="field", value="value", ids=["o_orderkey"])


@query(
    "spread_found_values",
    "G1",
    "SELECT p_brand, count(*) FILTER (WHERE p_type = 'ECONOMY') AS \"ECONOMY\", "
    + ", ".join(f"count(*) FILTER (WHERE p_type = '{c}') AS \"{c}\"" for c in TYPES[1:])
    + " FROM part GROUP BY 1",
)
def spread_found_values(t: SalesTables) -> DataFrame:
    counted = t.table("part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return r.spread(counted, ["p_brand"], "p_type", "n").fillna(0)


_FRAME = ", ".join(
    f'round(coalesce({_CELL.format("frame_material", f)}, 0.0), 2) AS {f}' for f in FRAMES
)


@query(
    "frame_gap_table",
    "P15 G3 M11",
    with_sales(
        f"SELECT category_1, category_2, {_FRAME}, round(sum(total_price), 2) AS total_sales "
        "FROM sales GROUP BY 1, 2"
    ),
)
def frame_gap_table(t: SalesTables) -> DataFrame:
    gaps = p.frame_gaps(t.sales("category_1", "category_2", "frame_material", "total_price"), FRAMES)
    return rounded(gaps, total_sales=2, **{f: 2 for f in FRAMES})


_FRAME_MONEY = ", ".join(
    f"""'$' || format('{{:,.0f}}', round(coalesce({_CELL.format("frame_material", f)}, 0.0), 4)) AS {f}"""
    for f in FRAMES
)


@query(
    "frame_gap_report",
    "P15 G3 X1 C15",
    with_sales(
        f'SELECT category_1 AS "Primary Category", category_2 AS "Secondary Category", {_FRAME_MONEY}, '
        "'$' || format('{:,.0f}', round(sum(total_price), 4)) AS \"Total Sales\" FROM sales GROUP BY 1, 2"
    ),
)
def frame_gap_report(t: SalesTables) -> DataFrame:
    return p.frame_gap_report(
        t.sales("category_1", "category_2", "frame_material", "total_price"), FRAMES
    )


@query(
    "wide_sorted_by_column",
    "O4",
    with_sales(f"SELECT city, {_WIDE} FROM sales GROUP BY 1"),
)
def wide_sorted_by_column(t: SalesTables) -> DataFrame:
    summed = t.sales("city", "category_1", "total_price").groupBy("city", "category_1").agg(
        F.sum("total_price").alias("sales")
    )
    wide = sort_rows(r.spread(summed, ["city"], "category_1", "sales", TYPES), "-PROMO", "city")
    return rounded(wide, **{c: 2 for c in TYPES})
