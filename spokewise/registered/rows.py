"""Filters, sorts, positions and binds."""

import datetime

from pyspark.sql import DataFrame, functions as F

from spokewise.functions.text import detect
from spokewise.operators.aggregates import count_rows
from spokewise.operators.joins import bind_columns, bind_rows, cast_keys, left_join, star_join
from spokewise.operators.ordering import sort_by_code, sort_rows
from spokewise.operators.positions import (
    equal_buckets,
    first_rows,
    last_rows,
    null_first_rows,
    row_index,
    slice_rows,
    split_at,
)
from spokewise.operators.rows import above_mean, distinct_rows, keep_rows, not_in, present
from spokewise.plans.products import models_with, price_buckets
from spokewise.plans.sales import SalesTables
from spokewise.plans.series import last_orders_between, orders_between
from spokewise.registered.registry import (
    LINE_KEY,
    as_long,
    lines_with_price,
    query,
    rounded,
    with_sales,
)

_ORDER = list(SalesTables.LINE_KEY)
_CATEGORIES = ["hot", "red", "old"]


def _products(t: SalesTables) -> DataFrame:
    return t.bikes().select("bike_id", "model", "price")


_PRODUCT_SQL = "SELECT p_partkey AS bike_id, p_name AS model, p_retailprice AS price FROM part "


@query(
    "price_above_mean",
    "R6",
    _PRODUCT_SQL + "WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part)",
)
def price_above_mean(t: SalesTables) -> DataFrame:
    return above_mean(_products(t), "price")


@query(
    "price_extremes",
    "R2 O2",
    _PRODUCT_SQL + "WHERE p_retailprice > 990 OR p_retailprice < 910",
)
def price_extremes(t: SalesTables) -> DataFrame:
    rows = keep_rows(_products(t), (F.col("price") > 990) | (F.col("price") < 910))
    return sort_rows(rows, "-price", "bike_id")


@query(
    "price_and_model",
    "R3 T1",
    _PRODUCT_SQL + "WHERE p_retailprice > 950 AND regexp_matches(p_name, 'ring')",
)
def price_and_model(t: SalesTables) -> DataFrame:
    return keep_rows(_products(t), F.col("price") > 950, detect(F.col("model"), "ring"))


def _lines_by_category(t: SalesTables) -> DataFrame:
    s = t.sales("order_id", "order_line", "category_2")
    nullable = F.when(F.col("category_2") != "new", F.col("category_2"))
    return s.withColumn("category_2", nullable)


_CATEGORY_SQL = (
    "SELECT order_id, order_line, nullif(category_2, 'new') AS category_2 FROM sales WHERE "
)


@query("category_in", "R4", with_sales(_CATEGORY_SQL + "category_2 IN ('hot', 'red', 'old')"))
def category_in(t: SalesTables) -> DataFrame:
    return keep_rows(_lines_by_category(t), F.col("category_2").isin(_CATEGORIES))


@query(
    "category_not_in_nullable",
    "R5",
    with_sales(_CATEGORY_SQL + "NOT coalesce(nullif(category_2, 'new') IN ('hot', 'red', 'old'), false)"),
)
def category_not_in_nullable(t: SalesTables) -> DataFrame:
    return keep_rows(_lines_by_category(t), not_in(F.col("category_2"), _CATEGORIES))


@query("category_equal", "R1", with_sales(_CATEGORY_SQL + "category_2 = 'hot'"))
def category_equal(t: SalesTables) -> DataFrame:
    return keep_rows(_lines_by_category(t), F.col("category_2") == "hot")


@query("category_unequal", "R1", with_sales(_CATEGORY_SQL + "nullif(category_2, 'new') <> 'hot'"))
def category_unequal(t: SalesTables) -> DataFrame:
    return keep_rows(_lines_by_category(t), F.col("category_2") != "hot")


@query("category_present", "R8 M8", with_sales(_CATEGORY_SQL + "category_2 <> 'new'"))
def category_present(t: SalesTables) -> DataFrame:
    return present(_lines_by_category(t), "category_2")


@query(
    "models_with_word",
    "R7 T1 T2",
    with_sales(
        "SELECT order_id, order_line, model, true AS is_ring FROM sales "
        "WHERE regexp_matches(lower(model), 'ring')"
    ),
)
def models_with_word(t: SalesTables) -> DataFrame:
    return models_with(t.sales("order_id", "order_line", "model"), "ring", "is_ring")


_DATED = (
    "SELECT CAST(order_date AS DATE) AS order_date, order_id, order_line, quantity FROM sales "
    "WHERE CAST(order_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-01-01'"
)
_FROM, _TO = datetime.date(1996, 1, 1), datetime.date(1997, 1, 1)


@query("date_between", "R9 D5 P20", with_sales(_DATED))
def date_between(t: SalesTables) -> DataFrame:
    return orders_between(t.sales("order_date", "order_id", "order_line", "quantity"), _FROM, _TO)


@query(
    "last_orders_in_range",
    "R12 P20",
    "SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderkey AS order_id FROM orders "
    "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-01-01' "
    "ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 6",
)
def last_orders_in_range(t: SalesTables) -> DataFrame:
    orders = t.table("orders").select(
        F.col("o_orderdate").alias("order_date"), F.col("o_orderkey").alias("order_id")
    )
    return last_orders_between(orders, _FROM, _TO, ["order_date", "order_id"])


@query(
    "cheapest_ten",
    "R11 O5 O2",
    _PRODUCT_SQL + "ORDER BY p_retailprice, p_partkey LIMIT 10",
)
def cheapest_ten(t: SalesTables) -> DataFrame:
    return last_rows(_products(t), ["-price", "-bike_id"], 10)


@query(
    "dearest_ten",
    "O5 R10",
    _PRODUCT_SQL + "ORDER BY p_retailprice DESC, p_partkey LIMIT 10",
)
def dearest_ten(t: SalesTables) -> DataFrame:
    return first_rows(_products(t), ["-price", "bike_id"], 10)


@query("sorted_by_price", "O1 O2", _PRODUCT_SQL + "ORDER BY p_retailprice DESC, p_partkey")
def sorted_by_price(t: SalesTables) -> DataFrame:
    return sort_rows(_products(t), "-price", "bike_id")


_NUMBERED = f"""numbered AS (
  SELECT order_id, order_line, product_id, supplier_id, quantity, list_amount,
    row_number() OVER (ORDER BY {LINE_KEY}) AS rn, count(*) OVER () AS n FROM sales)"""
_LINE_COLUMNS = "order_id, order_line, product_id, supplier_id, quantity, list_amount"


def _cut(lines: DataFrame) -> int:
    return lines.count() * 48 // 100


@query(
    "slice_range",
    "R10",
    with_sales(f"SELECT {_LINE_COLUMNS} FROM numbered WHERE rn > n * 48 // 100", _NUMBERED),
)
def slice_range(t: SalesTables) -> DataFrame:
    lines = t.lines()
    count = lines.count()
    return slice_rows(lines, _ORDER, count * 48 // 100 + 1, count)


@query(
    "slice_first_two",
    "R10",
    with_sales(f"SELECT {_LINE_COLUMNS} FROM numbered WHERE rn <= 2", _NUMBERED),
)
def slice_first_two(t: SalesTables) -> DataFrame:
    return slice_rows(t.lines(), _ORDER, 1, 2)


@query(
    "train_test_union",
    "R16 J6 P22",
    with_sales(
        f"SELECT {_LINE_COLUMNS}, CASE WHEN rn <= n * 48 // 100 THEN 'train' ELSE 'test' END AS part "
        "FROM numbered",
        _NUMBERED,
    ),
)
def train_test_union(t: SalesTables) -> DataFrame:
    lines = t.lines()
    train, test = split_at(lines, _ORDER, _cut(lines))
    return bind_rows(
        train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))
    )


@query(
    "row_positions",
    "W12",
    with_sales(f"SELECT {_LINE_COLUMNS}, rn AS row_index FROM numbered", _NUMBERED),
)
def row_positions(t: SalesTables) -> DataFrame:
    return row_index(t.lines(), _ORDER)


@query(
    "blanked_first_rows",
    "R15",
    with_sales(
        "SELECT order_id, order_line, product_id, supplier_id, quantity, "
        "CASE WHEN rn > 4 THEN list_amount END AS list_amount FROM numbered",
        _NUMBERED,
    ),
)
def blanked_first_rows(t: SalesTables) -> DataFrame:
    return null_first_rows(t.lines(), "list_amount", _ORDER, 4)


@query(
    "price_ntile",
    "W11 F9 P9",
    with_sales(
        f"SELECT {LINE_KEY}, round(total_price, 2) AS total_price, "
        f"ntile(3) OVER (ORDER BY total_price, {LINE_KEY}) AS total_price_binned FROM sales"
    ),
)
def price_ntile(t: SalesTables) -> DataFrame:
    priced = lines_with_price(t).select(*_ORDER, "total_price")
    return rounded(as_long(price_buckets(priced, _ORDER), "total_price_binned"), total_price=2)


@query(
    "nullable_ntile",
    "W11",
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN ntile(4) OVER (PARTITION BY c_acctbal >= 0 "
    "ORDER BY c_acctbal, c_custkey) END AS bucket FROM customer",
)
def nullable_ntile(t: SalesTables) -> DataFrame:
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    customers = t.table("customer").select("c_custkey", balance)
    return as_long(equal_buckets(customers, "balance", 4, ["c_custkey"]), "bucket").drop("balance")


@query("distinct_rows", "R13", "SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem")
def distinct_line_rows(t: SalesTables) -> DataFrame:
    return distinct_rows(t.table("lineitem").select("l_orderkey", "l_returnflag"))


@query(
    "distinct_categories",
    "R14 P13",
    "SELECT DISTINCT p_type AS category_1, split_part(p_name, ' ', 1) AS category_2 FROM part "
    "WHERE p_partkey IN (SELECT l_partkey FROM lineitem)",
)
def distinct_categories(t: SalesTables) -> DataFrame:
    return distinct_rows(t.sales("category_1", "category_2"), "category_1", "category_2")


@query(
    "distinct_cities",
    "R14",
    with_sales("SELECT DISTINCT city, state FROM sales"),
)
def distinct_cities(t: SalesTables) -> DataFrame:
    return distinct_rows(t.sales("city", "state"))


@query(
    "count_by_brand",
    "O6 A15",
    "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC",
)
def count_by_brand(t: SalesTables) -> DataFrame:
    return count_rows(t.table("part"), "p_brand", sort=True)


@query(
    "sorted_by_month_order",
    "O3",
    "SELECT strftime(o_orderdate, '%b') AS month, CAST(month(o_orderdate) AS INTEGER) AS month_code, "
    "count(*) AS n FROM orders GROUP BY 1, 2",
)
def sorted_by_month_order(t: SalesTables) -> DataFrame:
    day = F.col("o_orderdate")
    orders = t.table("orders").select(
        F.date_format(day, "MMM").alias("month"), F.month(day).alias("month_code")
    )
    return sort_by_code(count_rows(orders, "month", "month_code"), "month")


@query(
    "left_join_renamed_key",
    "J1",
    "SELECT l_orderkey AS order_id, l_partkey AS product_id, p_name AS model, p_retailprice AS price "
    "FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
)
def left_join_renamed_key(t: SalesTables) -> DataFrame:
    return left_join(
        t.lines().select("order_id", "product_id"), _products(t), {"product_id": "bike_id"}
    )


_NULLABLE_KEYS = (
    "SELECT c_custkey, a.nation, n_name FROM "
    "(SELECT c_custkey, nullif(c_nationkey, 0) AS nation FROM customer) a LEFT JOIN "
    "(SELECT nullif(n_nationkey, 0) AS nation, n_name FROM nation) b ON a.nation {0} b.nation"
)


def _nullable_keys(t: SalesTables) -> tuple[DataFrame, DataFrame]:
    """Customers and nations, with nation 0 replaced by NULL on both sides."""
    customers = t.table("customer").select(
        "c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("nation")
    )
    nations = t.table("nation").select(F.nullif("n_nationkey", F.lit(0)).alias("nation"), "n_name")
    return customers, nations


@query("left_join_nullable_keys", "J1 J2", _NULLABLE_KEYS.format("="))
def left_join_nullable_keys(t: SalesTables) -> DataFrame:
    return left_join(*_nullable_keys(t), ["nation"])


@query("left_join_missing_keys_match", "J1 J2", _NULLABLE_KEYS.format("IS NOT DISTINCT FROM"))
def left_join_missing_keys_match(t: SalesTables) -> DataFrame:
    return left_join(*_nullable_keys(t), ["nation"], na_matches=True)


@query(
    "star_join_text_keys",
    "J3 J4",
    "SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey "
    "LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def star_join_text_keys(t: SalesTables) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", F.col("o_custkey").cast("string"))
    customers = t.table("customer").select("c_custkey", "c_name", "c_nationkey")
    nations = t.table("nation").select("n_nationkey", "n_name")
    joined = star_join(
        cast_keys(orders, "o_custkey"),
        (customers, {"o_custkey": "c_custkey"}),
        (nations, {"c_nationkey": "n_nationkey"}),
    )
    return joined.select("o_orderkey", "c_name", "n_name")


@query(
    "bind_columns",
    "J5",
    "SELECT a.l_orderkey AS order_id, b.l_extendedprice AS list_amount FROM "
    "(SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "l_extendedprice) AS rn FROM lineitem) a JOIN (SELECT l_extendedprice, row_number() OVER "
    "(ORDER BY l_extendedprice DESC, l_orderkey) AS rn FROM lineitem) b USING (rn)",
)
def bound_columns(t: SalesTables) -> DataFrame:
    lines = t.lines()
    ids = lines.select(*_ORDER).toDF(*[f"{n}_left" for n in _ORDER])
    amounts = lines.select("list_amount", F.col("order_id").alias("tie"))
    bound = bind_columns(ids, amounts, [f"{n}_left" for n in _ORDER], ["-list_amount", "tie"])
    return bound.select(F.col("order_id_left").alias("order_id"), "list_amount")
