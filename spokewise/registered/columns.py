"""Column choice and naming."""

from pyspark.sql import DataFrame, functions as F

from spokewise.operators import columns as c
from spokewise.operators.aggregates import missing_share
from spokewise.operators.profiles import full_profile
from spokewise.plans.sales import SalesTables, clean_order_lines
from spokewise.plans.summaries import shop_revenue
from spokewise.registered.registry import query, rounded, with_sales

_SHOP_REVENUE = (
    "SELECT bikeshop_name AS {0}, category_1 AS {1}, round(sum(total_price), 2) AS {2} "
    "FROM sales GROUP BY 1, 2"
)


@query(
    "select_helpers",
    "C1 C3 C4 C5 C6 C8 C10",
    with_sales(
        "SELECT order_date, order_id, order_line, price, round(total_price, 2) AS total_price, "
        "category_1, category_2, city, state FROM sales"
    ),
)
def select_helpers(t: SalesTables) -> DataFrame:
    s = t.sales()
    chosen = c.pick(
        s,
        c.contains(s, "DATE"),
        c.starts_with(s, "order"),
        c.ends_with(s, "price"),
        c.matches(s, "_[0-9]$"),
        c.any_of(s, ["country", "city"]),
        c.all_of(s, ["city"]),
        c.last_column(s),
    )
    return rounded(chosen, total_price=2)


@query(
    "select_text_columns",
    "C12",
    with_sales(
        "SELECT model, category_1, category_2, frame_material, bikeshop_name, city, state FROM sales"
    ),
)
def select_text_columns(t: SalesTables) -> DataFrame:
    s = t.sales()
    return c.pick(s, c.of_kind(s, "text"))


@query(
    "select_number_columns",
    "C12",
    with_sales(
        "SELECT order_id, order_line, quantity, price, round(total_price, 2) AS total_price FROM sales"
    ),
)
def select_number_columns(t: SalesTables) -> DataFrame:
    # The shop columns are no numbers, so the shop joins are left out.
    s = t.sales("order_date", "order_id", "order_line", "quantity", "price", "total_price", "model")
    return rounded(c.pick(s, c.of_kind(s, "number")), total_price=2)


@query(
    "select_other_than_numbers",
    "C12",
    with_sales(
        "SELECT order_date, model, category_1, category_2, frame_material, bikeshop_name, city, state "
        "FROM sales"
    ),
)
def select_other_than_numbers(t: SalesTables) -> DataFrame:
    s = t.sales()
    return c.pick(s, c.not_of_kind(s, "number"))


@query(
    "drop_columns",
    "C2",
    "SELECT l_quantity AS quantity, l_extendedprice AS list_amount FROM lineitem",
)
def drop_columns(t: SalesTables) -> DataFrame:
    lines = t.lines()
    return c.omit(lines, c.ends_with(lines, "id"), c.contains(lines, "order"))


@query(
    "reorder_columns",
    "C9 C11 C13",
    with_sales(
        "SELECT bikeshop_name, city, state, order_id, order_line, model FROM sales"
    ),
)
def reorder_columns(t: SalesTables) -> DataFrame:
    s = t.sales("order_id", "order_line", "model", "bikeshop_name", "city", "state")
    return c.move_first(s, c.between_columns(s, "bikeshop_name", "state"))


@query(
    "numbered_columns",
    "C7 C16 T17",
    "SELECT split_part(p_name, ' ', 1) AS word_1, split_part(p_name, ' ', 2) AS word_2, "
    "p_type AS kind FROM part",
)
def numbered_columns(t: SalesTables) -> DataFrame:
    named = c.set_names(
        t.table("part").select(
            "p_type", F.split("p_name", " ")[0], F.split("p_name", " ")[1], "p_size"
        ),
        ["kind", "word_1", "word_2", "word_x"],
    )
    return c.pick(named, c.num_range(named, "word_", range(1, 5)), "kind")


@query(
    "pulled_mean",
    "C14 A6",
    with_sales("SELECT round(avg(total_price), 4) AS mean_total_price FROM sales"),
)
def pulled_mean(t: SalesTables) -> DataFrame:
    values = c.one_column(t.sales("quantity", "total_price"))
    return values.agg(F.round(F.avg("total_price"), 4).alias("mean_total_price"))


def _revenue(t: SalesTables) -> DataFrame:
    return rounded(shop_revenue(t.sales("bikeshop_name", "category_1", "total_price")), sales=2)


@query(
    "rename_columns",
    "C15",
    with_sales(_SHOP_REVENUE.format('"Bike Shop Name"', '"Primary Category"', '"Sales"')),
)
def rename_columns(t: SalesTables) -> DataFrame:
    return c.rename(
        _revenue(t),
        {"bikeshop_name": "Bike Shop Name", "category_1": "Primary Category", "sales": "Sales"},
    )


@query(
    "set_all_names",
    "C16",
    with_sales(_SHOP_REVENUE.format('"Shop"', '"Category"', '"Amount"')),
)
def set_all_names(t: SalesTables) -> DataFrame:
    return c.set_names(_revenue(t), ["Shop", "Category", "Amount"])


@query(
    "sentence_case_names",
    "C17 T14",
    with_sales(_SHOP_REVENUE.format('"Bikeshop name"', '"Category 1"', '"Sales"')),
)
def sentence_case_names(t: SalesTables) -> DataFrame:
    return c.rename_with(_revenue(t), c.sentence_name)


@query(
    "prefix_range_of_names",
    "C18",
    with_sales(
        "SELECT price, model AS prod_model, category_1 AS prod_category_1, "
        "category_2 AS prod_category_2, frame_material AS prod_frame_material, "
        "bikeshop_name AS cust_bikeshop_name, city AS cust_city, state AS cust_state FROM sales"
    ),
)
def prefix_range_of_names(t: SalesTables) -> DataFrame:
    s = t.sales(
        "price", "model", "category_1", "category_2", "frame_material",
        "bikeshop_name", "city", "state",
    )
    s = c.rename_with(s, "prod_{}".format, c.between_columns(s, "model", "frame_material"))
    return c.rename_with(s, "cust_{}".format, c.between_columns(s, "bikeshop_name", "state"))


@query(
    "suffix_and_respell_names",
    "C19 C20",
    "SELECT p_partkey AS \"bike-id_bike\", p_name AS model_bike, p_retailprice AS price_bike "
    "FROM part",
)
def suffix_and_respell_names(t: SalesTables) -> DataFrame:
    bikes = t.bikes().select("bike_id", "model", "price")
    respelt = c.rename_with(bikes, lambda n: n.replace("_", "-", 1))
    return c.rename_with(respelt, "{}_bike".format)


@query(
    "clean_column_names",
    "C21",
    'SELECT l_orderkey AS "index", l_orderkey AS order_id, l_linenumber AS order_line, '
    "l_quantity AS quantity, l_quantity AS quantity_2 FROM lineitem",
)
def clean_column_names(t: SalesTables) -> DataFrame:
    raw = t.table("lineitem").select(
        "l_orderkey", "l_orderkey", "l_linenumber", "l_quantity", "l_quantity"
    )
    return clean_order_lines(raw.toDF("...1", "Order ID", "order-Line", "Quantity", " quantity "))


@query(
    "sequential_columns",
    "C22 M1",
    with_sales(
        "SELECT order_id, round(-(quantity * 2), 2) AS quantity, "
        "round(-(quantity * 2) * price, 2) AS refund FROM sales"
    ),
)
def sequential_columns(t: SalesTables) -> DataFrame:
    s = t.sales("order_id", "quantity", "price")
    s = c.add_columns(
        s,
        quantity=F.col("quantity") * 2 * -1,
        refund=F.col("quantity") * F.col("price"),
    )
    return rounded(s.drop("price"), quantity=2, refund=2)


@query(
    "change_number_columns",
    "C23",
    "SELECT c_name, c_mktsegment, CAST(c_custkey AS DOUBLE) / 2 AS c_custkey, "
    "CAST(c_nationkey AS DOUBLE) / 2 AS c_nationkey, c_acctbal / 2 AS c_acctbal FROM customer",
)
def change_number_columns(t: SalesTables) -> DataFrame:
    customers = t.table("customer")
    return c.change_columns(
        customers, c.of_kind(customers, "number"), lambda x: x.cast("double") / 2
    )


def _profile_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", count(*) AS \"rows\", count(*) - count({n}) AS missing, "
        f"round(avg({n}), 4) AS mean, round(stddev_samp({n}), 4) AS sd, "
        f'CAST(min({n}) AS DOUBLE) AS "min", CAST(max({n}) AS DOUBLE) AS "max", CAST(NULL AS INTEGER) AS shortest, '
        f"CAST(NULL AS INTEGER) AS longest, CAST(0 AS BIGINT) AS empty FROM {table}"
        for n in columns
    )


@query(
    "column_profile",
    "C25 A5",
    _profile_sql("lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]),
)
def column_profile(t: SalesTables) -> DataFrame:
    profile = c.profile_columns(
        t.table("lineitem"), ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    )
    return rounded(profile, mean=4, sd=4)


@query(
    "missing_by_column",
    "A13",
    "SELECT avg(CASE WHEN c_name IS NULL THEN 1.0 ELSE 0.0 END) AS c_name, "
    "round(avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END), 6) AS c_acctbal FROM customer",
)
def missing_by_column(t: SalesTables) -> DataFrame:
    blanked = t.table("customer").select(
        "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    )
    return rounded(missing_share(blanked), c_acctbal=6)


_PROFILED = {
    "quantity": "CAST(quantity AS DOUBLE)",
    "order_id": "CAST(order_id AS DOUBLE)",
    "total_price": "total_price",
    "order_date": "CAST(CAST(order_date AS DATE) - DATE '1970-01-01' AS DOUBLE)",
    "model": "CAST(NULL AS DOUBLE)",
    "city": "CAST(NULL AS DOUBLE)",
}
_CELLS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS v, {x} AS x FROM sales""" for c, x in _PROFILED.items()
)
_BIN = "CASE WHEN hi > lo THEN least(CAST(floor((x - lo) / (hi - lo) * 10) AS INTEGER), 9) ELSE 0 END"


@query(
    "full_profile_of_sales",
    "C25",
    with_sales(
        'SELECT f.*, histogram FROM f LEFT JOIN h USING ("column")',
        f"u AS ({_CELLS})",
        """f AS (SELECT "column", count(*) AS rows, count(*) - count(v) AS missing, count(DISTINCT v) AS "distinct",
  min(x) AS p0, round(quantile_cont(x, 0.25), 4) AS p25, round(quantile_cont(x, 0.5), 4) AS p50,
  round(quantile_cont(x, 0.75), 4) AS p75, max(x) AS p100 FROM u GROUP BY 1)""",
        f"""b AS (SELECT "column", {_BIN} AS bin, count(*) AS c
  FROM u JOIN (SELECT "column", min(x) AS lo, max(x) AS hi FROM u GROUP BY 1) USING ("column")
  WHERE x IS NOT NULL GROUP BY 1, 2)""",
        """h AS (SELECT name AS "column", string_agg(CAST(coalesce(c, 0) AS VARCHAR), ' ' ORDER BY k) AS histogram
  FROM (SELECT name, unnest(range(10)) AS k FROM (SELECT DISTINCT "column" AS name FROM b))
  LEFT JOIN b ON b."column" = name AND bin = k GROUP BY 1)""",
    ),
)
def full_profile_of_sales(t: SalesTables) -> DataFrame:
    sales = t.sales(*_PROFILED).withColumn("order_date", F.to_date("order_date"))
    found = full_profile(sales, list(_PROFILED)).withColumn("histogram", F.array_join("histogram", " "))
    return rounded(found, p25=4, p50=4, p75=4)
