"""Sales by category, shop and attribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from spokewise.functions.formats import with_dollar_text, with_dollar_texts
from spokewise.functions.text import detect
from spokewise.operators.aggregates import missing_share, quantiles, six_statistics
from spokewise.operators.columns import rename, rename_with, sentence_name
from spokewise.operators.ordering import Order, sort_rows
from spokewise.operators.positions import null_first_rows
from spokewise.operators.reshape import gather, gather_money, spread, zero_filled_totals
from spokewise.plans.sales import dollars_by


def revenue_by_groups(sales: DataFrame, *keys: str) -> DataFrame:
    """Revenue per group, largest first."""
    keys = keys or ("category_1", "category_2", "frame_material")
    revenue = dollars_by(sales, *keys).withColumnRenamed("sales", "revenue")
    return sort_rows(revenue, "-revenue", *keys)


def price_statistics(sales: DataFrame, *keys: str) -> DataFrame:
    """Six statistics of the order-line value per group, most frequent group first."""
    keys = keys or ("category_1", "category_2")
    return sort_rows(six_statistics(sales, keys, "total_price"), "-count", *keys)


def missing_profile(sales: DataFrame, order_by: Order, count: int = 4) -> DataFrame:
    """Blank the first values of ``total_price`` and measure missing values per column."""
    return missing_share(null_first_rows(sales, "total_price", order_by, count))


def shop_revenue(sales: DataFrame) -> DataFrame:
    return dollars_by(sales, "bikeshop_name", "category_1")


def shop_revenue_wide(sales: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row per shop, one numeric column per category, first category descending."""
    wide = spread(shop_revenue(sales), ["bikeshop_name"], "category_1", "sales", categories)
    return sort_rows(wide, f"-{categories[0]}", "bikeshop_name")


def shop_revenue_report(sales: DataFrame, categories: Sequence[str]) -> DataFrame:
    """The wide table as money text under sentence-case names."""
    wide = shop_revenue_wide(sales, categories)
    report = with_dollar_texts(wide, {c: c for c in categories})
    return rename_with(report, sentence_name, ["bikeshop_name"])


def shop_revenue_long(sales: DataFrame, categories: Sequence[str]) -> DataFrame:
    return gather(shop_revenue_wide(sales, categories), categories, "category_1", "sales")


def shop_report_to_long(report: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Back from money text to numbers; dropped cents stay lost."""
    return gather_money(report, categories, "category_1", "sales")


def sales_report_by(sales: DataFrame, key: str, title: str) -> DataFrame:
    """Sales per value of one key as money text, largest first, under report names."""
    ranked = with_dollar_text(dollars_by(sales, key), "sales")
    report = sort_rows(ranked, "-sales", key).select(key, "sales_text")
    return rename(report, {key: title, "sales_text": "Sales"})


def frame_gaps(sales: DataFrame, frames: Sequence[str]) -> DataFrame:
    """Sales by category pair with a column per frame material, gaps as 0, and the total."""
    summed = dollars_by(sales, "category_1", "category_2", "frame_material")
    wide = spread(summed, ["category_1", "category_2"], "frame_material", "sales", frames)
    totals = zero_filled_totals(wide, frames)
    totals = totals.withColumn("total_sales", F.round("total_sales", 4))
    return sort_rows(totals, "-total_sales", "category_1", "category_2")


def frame_gap_report(sales: DataFrame, frames: Sequence[str]) -> DataFrame:
    amounts = (*frames, "total_sales")
    report = with_dollar_texts(frame_gaps(sales, frames), {c: c for c in amounts})
    return rename(
        report,
        {
            "category_1": "Primary Category",
            "category_2": "Secondary Category",
            "total_sales": "Total Sales",
        },
    )


def median_by_attributes(sales: DataFrame, words: Sequence[str]) -> DataFrame:
    """Median order-line value of models with and without each word in their name.

    All words share one pass: each row counts once per word.
    """
    model = F.col("model")
    tests = F.array(
        *[
            F.struct(F.lit(w).alias("word"), detect(model, w, ignore_case=True).alias("has_word"))
            for w in words
        ]
    )
    flagged = sales.select("total_price", F.inline(tests))
    return quantiles(flagged, ["word", "has_word"], "total_price", {"sales_median": 0.5})


def median_report(sales: DataFrame, word: str, title: str) -> DataFrame:
    medians = median_by_attributes(sales, [word])
    text = with_dollar_text(medians, "sales_median", largest_with_cents=10)
    return text.select(
        F.col("has_word").alias(title), F.col("sales_median_text").alias("Median Sales")
    )
