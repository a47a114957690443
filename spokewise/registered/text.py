"""Text and number-format expressions over whole columns."""

from pyspark.sql import DataFrame, functions as F

from spokewise.functions import formats as fm
from spokewise.functions import text as tx
from spokewise.operators.columns import clean_names, move_first, omit, rename_with, starts_with
from spokewise.plans.products import purchase_statements
from spokewise.plans.sales import SalesTables, split_description, split_location
from spokewise.registered.registry import query, rounded, with_sales


@query(
    "string_case_concat",
    "T2 T3 T4 T5",
    "SELECT p_partkey, lower(p_type) AS lower, upper(p_name) AS upper, "
    "upper(p_type[1]) || lower(p_type[2:]) AS sentence, "
    "upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || "
    "upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS title, "
    "p_name || ' / ' || p_brand AS joined, CAST(NULL AS VARCHAR) AS joined_missing FROM part",
)
def string_case_concat(t: SalesTables) -> DataFrame:
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    return t.table("part").select(
        "p_partkey",
        F.lower(kind).alias("lower"),
        F.upper(name).alias("upper"),
        tx.sentence_case(kind).alias("sentence"),
        tx.title_case(name).alias("title"),
        tx.join_text(name, brand, sep=" / ").alias("joined"),
        tx.join_text(name, F.lit(None)).alias("joined_missing"),
    )


@query(
    "statement_text",
    "P19 T6 T3",
    with_sales(
        "SELECT order_id, order_line, bikeshop_name, 'Order line : ' || order_id || '.' || order_line "
        "|| ' sent to customer: ' || bikeshop_name AS purchase_statement FROM sales"
    ),
)
def statement_text(t: SalesTables) -> DataFrame:
    return purchase_statements(t.sales("order_id", "order_line", "bikeshop_name"))


@query(
    "glue_missing",
    "T6 T16",
    "SELECT p_partkey, coalesce(nullif(p_type, 'PROMO'), 'NA') || ': ' || p_name AS label, "
    "coalesce(nullif(p_type, 'PROMO'), 'NA') || '-' || p_brand AS united FROM part",
)
def glue_missing(t: SalesTables) -> DataFrame:
    parts = t.table("part").select(
        "p_partkey", "p_name", "p_brand", F.nullif(F.col("p_type"), F.lit("PROMO")).alias("kind")
    )
    labelled = parts.withColumn("label", tx.glue("{kind}: {p_name}"))
    return tx.unite(labelled, "united", ["kind", "p_brand"], sep="-").drop("p_name")


@query(
    "strip_digits",
    "T9 T12 T13",
    "SELECT p_partkey, trim(regexp_replace(p_brand, '[0-9]', '', 'g')) AS no_digits, "
    "regexp_replace(p_name, '[aeiou]', '*', 'g') AS masked, "
    "regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits FROM part",
)
def strip_digits(t: SalesTables) -> DataFrame:
    brand = F.col("p_brand")
    padded = F.concat(F.lit(" \t"), brand, F.lit("\n "))
    return t.table("part").select(
        "p_partkey",
        tx.trim(tx.replace_all(padded, "[0-9]")).alias("no_digits"),
        tx.replace_all(F.col("p_name"), "[aeiou]", "*").alias("masked"),
        tx.remove_all(brand, "[^0-9]").alias("digits"),
    )


@query(
    "replace_first",
    "T10 T11 T14",
    "SELECT p_partkey, regexp_replace(p_brand, '[0-9]', '') AS brand, "
    "trim(substr(p_name, length(split_part(p_name, ' ', 1)) + 1)) AS rest, "
    "replace(p_name, ' ', '_') AS underscored FROM part",
)
def replace_first(t: SalesTables) -> DataFrame:
    name = F.col("p_name")
    return t.table("part").select(
        "p_partkey",
        tx.replace_first(F.col("p_brand"), "[0-9]").alias("brand"),
        tx.trim(tx.replace_first(name, F.split(name, " ")[0])).alias("rest"),
        tx.replace_literal(name, " ", "_").alias("underscored"),
    )


@query(
    "split_pieces",
    "T7 T8",
    "SELECT p_partkey, len(string_split(p_name, ' ')) AS pieces, split_part(p_name, ' ', 1) AS piece_1, "
    "split_part(p_name, ' ', 2) AS piece_2, '' AS piece_3 FROM part",
)
def split_pieces(t: SalesTables) -> DataFrame:
    name = F.col("p_name")
    fixed = [c.alias(f"piece_{i}") for i, c in enumerate(tx.split_fixed(name, " ", 3), start=1)]
    return t.table("part").select(
        "p_partkey", F.size(tx.split_text(name, " ")).cast("bigint").alias("pieces"), *fixed
    )


@query(
    "split_descriptions",
    "T15",
    """SELECT bike_id, model, string_split(d, ' - ')[1] AS category_1, string_split(d, ' - ')[2] AS category_2,
      string_split(d, ' - ')[3] AS frame_material, price
    FROM (SELECT p_partkey AS bike_id, p_name AS model, p_retailprice AS price,
      CASE WHEN p_size > 25 THEN p_type || ' - ' || split_part(p_name, ' ', 1) || ' - '
        || split_part(p_name, ' ', 2) ELSE p_type || ' - ' || split_part(p_name, ' ', 1) END AS d
    FROM part)""",
)
def split_descriptions(t: SalesTables) -> DataFrame:
    sizes = t.table("part").select(F.col("p_partkey").alias("bike_id"), "p_size")
    bikes = t.bikes().join(sizes, "bike_id")
    short = F.substring_index("description", " - ", 2)
    bikes = bikes.withColumn(
        "description", F.when(F.col("p_size") > 25, F.col("description")).otherwise(short)
    )
    return split_description(bikes.drop("p_size"))


@query(
    "split_locations",
    "T15",
    "SELECT c_custkey AS bikeshop_id, c_name AS bikeshop_name, n_name || ', ' || r_name AS location, "
    "n_name AS city, r_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey",
)
def split_locations(t: SalesTables) -> DataFrame:
    return split_location(t.shops(), remove=False)


@query(
    "dollar_text",
    "X1 X2",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || '$' || "
    "format('{:,.2f}', abs(c_acctbal)) AS with_cents, CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END "
    "|| '$' || format('{:,.0f}', abs(c_acctbal)) AS no_cents FROM customer",
)
def dollar_text(t: SalesTables) -> DataFrame:
    balances = t.table("customer").select("c_custkey", "c_acctbal")
    balances = fm.with_dollar_text(balances, "c_acctbal", "with_cents")
    balances = fm.with_dollar_text(balances, "c_acctbal", "no_cents", largest_with_cents=10)
    return balances.drop("c_acctbal")


@query(
    "percent_text",
    "X5 X4",
    "SELECT l_orderkey, l_linenumber, format('{:.1f}%', round(100 * l_discount, 6)) AS discount, "
    "format('{:.0f}%', round(100 * l_tax, 6)) AS tax, "
    "format('{:,.1f}', l_quantity) || ' kg' AS quantity FROM lineitem",
)
def percent_text(t: SalesTables) -> DataFrame:
    return t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fm.percent_text(F.col("l_discount")).alias("discount"),
        fm.percent_text(F.col("l_tax"), accuracy=1).alias("tax"),
        fm.number_text(F.col("l_quantity"), 1, suffix=" kg").alias("quantity"),
    )


@query(
    "sales_wrangled",
    "P1 C2 C13 C21 J1 J3 J4 M1 T15",
    with_sales(
        """SELECT order_date, order_id, order_line, quantity, price, round(total_price, 2) AS total_price,
          model, string_split(description, ' - ')[1] AS category_1,
          string_split(description, ' - ')[2] AS category_2,
          string_split(description, ' - ')[3] AS frame_material, bikeshop_name, city, state
        FROM (SELECT *, category_1 || ' - ' || category_2 || ' - ' || frame_material AS description
          FROM sales)"""
    ),
)
def sales_wrangled(t: SalesTables) -> DataFrame:
    raw = t.sales().withColumn("x.1", F.lit(1))
    raw = rename_with(raw, lambda name: name.replace("_", ".", 1))
    cleaned = omit(clean_names(raw), "x_1")
    return rounded(move_first(cleaned, starts_with(cleaned, "order")), total_price=2)
