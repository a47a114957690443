"""Product features from model names, and price bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spokewise.functions.formats import with_dollar_texts
from spokewise.functions.numbers import first_case, natural_log, power, recode
from spokewise.functions.text import (
    detect,
    flag,
    glue,
    join_text,
    numbered_names,
    replace_first,
    separate,
    title_case,
    trim,
)
from spokewise.operators.aggregates import quantile_bands, summarise
from spokewise.operators.columns import contains, of_kind, omit, rename_with, title_name
from spokewise.operators.ordering import Order, sort_rows
from spokewise.operators.positions import equal_buckets

# Misspelt model names and their repair.
MODEL_REPAIRS = {
    "CAAD Disc Ultegra": "CAAD12 Disc Ultegra",
    "Syapse Carbon Tiagra": "Synapse Carbon Tiagra",
    "Supersix Evo Hi-Mod Utegra": "Supersix Evo Hi-Mod Ultegra",
}
# Fixed values: (word number, text in it, number of leading words in the base model).
BASE_MODEL_RULES = (
    (1, "supersix", 2),
    (1, "fat", 2),
    (1, "beast", 4),
    (1, "bad", 2),
    (2, "29", 2),
)
# Flag name and the text it stands for.
TIER_FLAGS = {
    "black": "black",
    "hi_mod": "hi-mod",
    "ultegra": "ultegra",
    "team": "team",
    "red": "red",
    "dura_ace": "dura ace",
    "disc": "disc",
}
# How many words of a model are told apart, and the text of a statement.
MODEL_WORDS = 7
STATEMENT = "Order line : {order_id}.{order_line} sent to customer: {shop}"


def base_model(rules: Sequence[tuple[int, str, int]] = BASE_MODEL_RULES) -> Column:
    """Leading words of a model, taken from its ``model_1``, ``model_2`` ... columns."""
    cases = []
    for position, text, words in rules:
        test = detect(F.col(f"model_{position}"), text, ignore_case=True)
        cases.append((test, join_text(*[F.col(n) for n in numbered_names("model_", words)], sep=" ")))
    return first_case(cases, F.col("model_1"))


def model_features(
    products: DataFrame,
    repairs: Mapping[str, str] = MODEL_REPAIRS,
    rules: Sequence[tuple[int, str, int]] = BASE_MODEL_RULES,
    flags: Mapping[str, str] = TIER_FLAGS,
) -> DataFrame:
    """Add the base model, the rest of the name as tier, and 0/1 flags of the tier.

    Every step works on one row, so the whole query is a single stage.
    """
    repaired = products.withColumn("model", recode(F.col("model"), repairs))
    words = separate(repaired, "model", numbered_names("model_", MODEL_WORDS), " ", remove=False)
    based = words.withColumn("base_model", base_model(rules))
    based = omit(based, contains(based, "model_"))
    tier = trim(replace_first(F.col("model"), F.col("base_model")))
    tiered = based.withColumn("model_tier", tier)
    return tiered.withColumns({n: flag(F.col("model_tier"), t) for n, t in flags.items()})


def price_by_base_model(
    sales: DataFrame,
    repairs: Mapping[str, str] = MODEL_REPAIRS,
    rules: Sequence[tuple[int, str, int]] = BASE_MODEL_RULES,
    distinct: bool = True,
) -> DataFrame:
    """Mean, least and greatest price per category pair and base model.

    By default each product counts once; else once per row of ``sales``.
    """
    rows = sales.select("category_1", "category_2", "model", "price")
    featured = model_features(rows.distinct() if distinct else rows, repairs, rules, {})
    price = F.col("price")
    priced = summarise(
        featured,
        ["category_1", "category_2", "base_model"],
        sales_avg=F.avg(price),
        sales_min=F.min(price),
        sales_max=F.max(price),
    )
    return sort_rows(priced, "-sales_avg", "category_1", "category_2", "base_model")


def base_model_price_report(prices: DataFrame) -> DataFrame:
    """All number columns as money text, names in title case."""
    numbers = of_kind(prices, "number")
    text = with_dollar_texts(prices, {n: n for n in numbers}, largest_with_cents=10)
    return rename_with(text, title_name)


def price_scales(sales: DataFrame) -> DataFrame:
    return sales.withColumns(
        {
            "total_price_log": natural_log(F.col("total_price")),
            "total_price_sqrt": power(F.col("total_price"), 0.5),
        }
    )


def models_with(sales: DataFrame, word: str, name: str) -> DataFrame:
    """Rows whose lower-cased model has the word, with the flag column."""
    flagged = sales.withColumn(name, detect(F.col("model"), word, ignore_case=True))
    return flagged.filter(F.col(name))


def model_type(sales: DataFrame, types: Mapping[str, str], otherwise: str) -> DataFrame:
    cases = [(detect(F.col("model"), w, ignore_case=True), F.lit(t)) for w, t in types.items()]
    return sales.withColumn("bike_type", first_case(cases, F.lit(otherwise)))


def price_buckets(sales: DataFrame, tie_break: Order, buckets: int = 3) -> DataFrame:
    return equal_buckets(sales, "total_price", buckets, tie_break, "total_price_binned")


def price_bands(sales: DataFrame) -> DataFrame:
    return quantile_bands(sales, "total_price", name="total_price_cat")


def purchase_statements(sales: DataFrame) -> DataFrame:
    """A sentence per order line."""
    text = glue(STATEMENT, shop=title_case(F.col("bikeshop_name")))
    return sales.withColumn("purchase_statement", text)
