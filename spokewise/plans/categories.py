"""Category revenue with ordered and lumped categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spokewise.operators.categories import (
    levels_by_appearance,
    levels_by_last,
    levels_by_summary,
    levels_by_value,
    lump,
    relevel,
    reverse_levels,
    with_codes,
)
from spokewise.plans.sales import dollars_by
from spokewise.plans.series import sales_by_quarter
from spokewise.session import stage

# Fixed value: name of the lumped category.
OTHER_CATEGORY = "all other bike category"


def category_revenue(sales: DataFrame, category: str = "category_2") -> DataFrame:
    """Revenue per category, staged: the steps that follow read it several times."""
    return stage(dollars_by(sales, category).withColumnRenamed("sales", "revenue"), "revenue")


def category_codes(sales: DataFrame, category: str = "category_2") -> DataFrame:
    """Revenue per category with its code by rank, by reversed rank and by name.

    Ranked from the largest revenue down, the order of appearance is the rank.
    """
    revenue = category_revenue(sales, category).withColumn("negative_sales", -F.col("revenue"))
    ranked = levels_by_appearance(revenue, category, ["negative_sales", category])
    coded = with_codes(revenue, category, ranked, "rank_code")
    coded = with_codes(coded, category, reverse_levels(ranked), "reversed_code")
    coded = with_codes(coded, category, levels_by_value(revenue, category), "name_code")
    return coded.drop("negative_sales")


def category_reordered(sales: DataFrame, category: str = "category_2") -> DataFrame:
    """Revenue per category, levels from the largest revenue to the smallest."""
    revenue = category_revenue(sales, category).withColumn("negative_sales", -F.col("revenue"))
    # There is one row per category, so its median is the value itself.
    levels = levels_by_summary(revenue, category, "negative_sales", F.max("negative_sales"))
    return with_codes(revenue, category, levels)


def quarterly_reordered(sales: DataFrame, category: str = "category_2") -> DataFrame:
    """Quarterly revenue, levels by the revenue of their last quarter."""
    quarterly = stage(sales_by_quarter(sales, category), "quarterly")
    return with_codes(
        quarterly, category, levels_by_last(quarterly, category, "order_quarter", "revenue")
    )


def category_lumped(
    sales: DataFrame, n: int = 6, category: str = "category_2", other: str = OTHER_CATEGORY
) -> DataFrame:
    """Revenue of the top categories and of all others together, the others first.

    The top categories keep their order from the smallest revenue up.
    """
    revenue = category_revenue(sales, category)
    lumped = lump(revenue, category, n, "revenue", other)
    summed = lumped.groupBy(category).agg(F.sum("revenue").alias("revenue"))
    levels = levels_by_appearance(summed, category, ["revenue", category])
    return with_codes(summed, category, relevel(levels, [other]))
