"""Ordered and lumped categories."""

from pyspark.sql import DataFrame, functions as F

from spokewise.operators import categories as g
from spokewise.operators.aggregates import count_rows
from spokewise.plans import categories as p
from spokewise.plans.sales import SalesTables
from spokewise.registered.registry import as_long, query, rounded, with_sales

_REVENUE = (
    "revenue AS (SELECT category_2, round(sum(total_price), 4) AS revenue FROM sales GROUP BY 1)"
)


def _sales(t: SalesTables) -> DataFrame:
    return t.sales("category_2", "total_price")


@query(
    "factor_codes",
    "F1 F2 F3 F4 P11",
    with_sales(
        """SELECT category_2, round(revenue, 2) AS revenue,
          row_number() OVER (ORDER BY revenue DESC) AS rank_code,
          row_number() OVER (ORDER BY revenue) AS reversed_code,
          row_number() OVER (ORDER BY category_2) AS name_code FROM revenue""",
        _REVENUE,
    ),
)
def factor_codes(t: SalesTables) -> DataFrame:
    coded = p.category_codes(_sales(t))
    return rounded(as_long(coded, "rank_code", "reversed_code", "name_code"), revenue=2)


@query(
    "factor_by_first_row",
    "F1",
    """WITH firsts AS (SELECT o_orderpriority AS level, min(o_orderkey) AS k FROM orders GROUP BY 1),
      codes AS (SELECT level, row_number() OVER (ORDER BY k) AS code FROM firsts)
    SELECT o_orderkey, o_orderpriority, code AS o_orderpriority_code
    FROM orders JOIN codes ON o_orderpriority = level""",
)
def factor_by_first_row(t: SalesTables) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", "o_orderpriority")
    levels = g.levels_by_appearance(orders, "o_orderpriority", ["o_orderkey"])
    return as_long(g.with_codes(orders, "o_orderpriority", levels), "o_orderpriority_code")


@query(
    "factor_reorder",
    "F6 P11",
    with_sales(
        """SELECT category_2, round(revenue, 2) AS revenue, round(-revenue, 2) AS negative_sales,
          row_number() OVER (ORDER BY revenue DESC) AS category_2_code FROM revenue""",
        _REVENUE,
    ),
)
def factor_reorder(t: SalesTables) -> DataFrame:
    ordered = as_long(p.category_reordered(_sales(t)), "category_2_code")
    return rounded(ordered, revenue=2, negative_sales=2)


@query(
    "factor_reorder_by_median",
    "F6 A7",
    """SELECT p_partkey, p_brand, code AS p_brand_code FROM part JOIN
      (SELECT p_brand, row_number() OVER (ORDER BY median(p_retailprice), p_brand) AS code
       FROM part GROUP BY 1) USING (p_brand)""",
)
def factor_reorder_by_median(t: SalesTables) -> DataFrame:
    parts = t.table("part").select("p_partkey", "p_brand", "p_retailprice")
    coded = g.with_codes(parts, "p_brand", g.levels_by_summary(parts, "p_brand", "p_retailprice"))
    return as_long(coded.drop("p_retailprice"), "p_brand_code")


@query(
    "factor_reorder2",
    "F7 P12",
    with_sales(
        """SELECT category_2, order_quarter, round(revenue, 2) AS revenue, code AS category_2_code
        FROM q JOIN (SELECT category_2, row_number() OVER (ORDER BY arg_max(revenue, order_quarter) DESC)
          AS code FROM q GROUP BY 1) USING (category_2)""",
        """q AS (SELECT category_2, CAST(date_trunc('quarter', order_date) AS DATE) AS order_quarter,
          round(sum(total_price), 4) AS revenue FROM sales GROUP BY 1, 2)""",
    ),
)
def factor_reorder2(t: SalesTables) -> DataFrame:
    ordered = p.quarterly_reordered(t.sales("order_date", "category_2", "total_price"))
    return rounded(as_long(ordered, "category_2_code"), revenue=2)


@query(
    "factor_relevel",
    "F8 A15",
    """SELECT p_type, count(*) AS n, row_number() OVER (ORDER BY CASE p_type WHEN 'SMALL' THEN 0
      WHEN 'LARGE' THEN 1 ELSE 2 END, p_type) AS p_type_code FROM part GROUP BY 1""",
)
def factor_relevel(t: SalesTables) -> DataFrame:
    counted = count_rows(t.table("part"), "p_type")
    levels = g.relevel(g.levels_by_value(counted, "p_type"), ["SMALL", "LARGE"])
    return as_long(g.with_codes(counted, "p_type", levels), "p_type_code")


@query(
    "category_lumped",
    "P11 F5 F8 W13",
    with_sales(
        """SELECT category_2, round(revenue, 2) AS revenue, row_number() OVER (ORDER BY
          category_2 <> 'all other bike category', revenue) AS category_2_code
        FROM (SELECT CASE WHEN rank <= 6 THEN category_2 ELSE 'all other bike category' END AS category_2,
          sum(revenue) AS revenue
          FROM (SELECT *, rank() OVER (ORDER BY revenue DESC) AS rank FROM revenue) GROUP BY 1)""",
        _REVENUE,
    ),
)
def category_lumped(t: SalesTables) -> DataFrame:
    return rounded(as_long(p.category_lumped(_sales(t)), "category_2_code"), revenue=2)


@query(
    "lumped_by_count",
    "F5 O6",
    """WITH ranked AS (SELECT p_brand, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS r
      FROM part GROUP BY 1)
    SELECT CASE WHEN r <= 5 OR (SELECT count(*) FROM ranked WHERE r > 5) = 1 THEN p_brand
      ELSE 'Other' END AS p_brand, CAST(sum(n) AS BIGINT) AS n FROM ranked GROUP BY 1""",
)
def lumped_by_count(t: SalesTables) -> DataFrame:
    return count_rows(g.lump(t.table("part").select("p_brand"), "p_brand", 5), "p_brand", sort=True)


@query(
    "single_rest_not_lumped",
    "F5",
    "SELECT p_type, count(*) AS n FROM part GROUP BY 1",
)
def single_rest_not_lumped(t: SalesTables) -> DataFrame:
    parts = t.table("part").select("p_type")
    return g.lump(parts, "p_type", 5).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
