"""The sales model: order lines joined with products and shops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from spokewise.functions.text import separate
from spokewise.operators.columns import clean_names, pick, rename
from spokewise.operators.joins import cast_keys, left_join
from spokewise.sources.files import read_table, write_csv, write_table

PRODUCT_COLUMNS = ("price", "model", "category_1", "category_2", "frame_material")
SHOP_COLUMNS = ("bikeshop_name", "city", "state")
PRICED = {*PRODUCT_COLUMNS, "total_price"}
SALES_COLUMNS = (
    "order_date",
    "order_id",
    "order_line",
    "quantity",
    "price",
    "total_price",
    "model",
    "category_1",
    "category_2",
    "frame_material",
    "bikeshop_name",
    "city",
    "state",
)

# Bytes of the written order lines in a piece of them. Each piece reads all lines and joins
# whole dimensions, so there are at most so many; from there on pieces grow with the table.
PIECE_BYTES = 64_000_000
MOST_PIECES = 8


def clean_order_lines(raw: DataFrame) -> DataFrame:
    """Clean the names of a raw order-line table, whose first column has no name."""
    lines = clean_names(raw)
    return rename(lines, {"x1": "index"}) if "x1" in lines.columns else lines


def split_description(bikes: DataFrame) -> DataFrame:
    return separate(
        bikes, "description", ["category_1", "category_2", "frame_material"], sep=" - "
    )


def split_location(shops: DataFrame, remove: bool = True) -> DataFrame:
    return separate(shops, "location", ["city", "state"], sep=", ", remove=remove)


def sales_model(
    order_lines: DataFrame,
    bikes: DataFrame | None,
    shops: DataFrame | None,
    columns: Sequence[str] = SALES_COLUMNS,
    places: DataFrame | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """Order lines with the wanted sales columns.

    With ``unique_keys`` the caller vouches for dimensions without repeated keys
    (see ``repeated_keys``). Then one none of whose columns is wanted is not
    joined, and may be None: it can change neither rows nor columns. Texts are
    split in the dimensions, once per product and shop, not per order line.

    Shops hold their ``location``, or a ``place_id`` of the table ``places``
    (place_id, location). That one is joined after the shops, so that each join
    has a plain table on its right, whose size Spark knows.
    """
    wanted = set(columns)
    sales = order_lines
    if not unique_keys or wanted & PRICED:
        products = cast_keys(split_description(bikes), "bike_id")
        keep = [c for c in PRODUCT_COLUMNS if c in wanted or c == "price"]
        products = pick(products, "bike_id", keep)
        sales = left_join(cast_keys(sales, "product_id"), products, {"product_id": "bike_id"})
        sales = sales.withColumn("total_price", F.col("quantity") * F.col("price"))
    placed = wanted & {"city", "state"}
    if not unique_keys or wanted & set(SHOP_COLUMNS):
        if places is None:
            shops = split_location(shops)
        elif unique_keys and not placed:
            shops = shops.drop("place_id")
        own = [c for c in (*SHOP_COLUMNS, "place_id") if c in shops.columns]
        shops = pick(cast_keys(shops, "bikeshop_id"), "bikeshop_id", own)
        sales = left_join(cast_keys(sales, "customer_id"), shops, {"customer_id": "bikeshop_id"})
        if places is not None and (not unique_keys or placed):
            sales = left_join(sales, split_location(places), {"place_id": "place_id"})
    return pick(sales, list(columns))


def export_sales(sales: DataFrame, folder: str, pieces: int = 1) -> None:
    """Write the sales table as Parquet by order year, and as CSV compressed by gzip.

    The CSV is written from the Parquet table, so the joins run once, or once for
    each of several ``pieces`` of the orders (see ``write_table``).
    """
    by_year = sales.withColumn("order_year", F.year("order_date"))
    write_table(by_year, f"{folder}/parquet", ["order_year"], pieces, "order_id")
    written = read_table(sales.sparkSession, f"{folder}/parquet", by_year.schema)
    write_csv(pick(written, sales.columns), f"{folder}/csv", compression="gzip")


# Declared, so that no file has to be opened to plan a query.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


class SalesTables:
    """The three sales tables over a folder of order, part and customer tables."""

    # Unique together in the line table, so it serves as a tie-break.
    LINE_KEY = ("order_id", "order_line", "product_id", "supplier_id", "list_amount")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        schema = StructType.fromDDL(TABLE_SCHEMAS[name])
        return read_table(self.spark, f"{self.folder}/{name}.parquet", schema)

    def lines(self) -> DataFrame:
        """Order lines without the columns of the order header."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("bigint").alias("order_line"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("list_amount"),
        )

    def pieces(self) -> int:
        """In how many pieces to join the order lines where the disk must not hold all shuffles at once."""
        size = self.table("lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return min(MOST_PIECES, int(str(size)) // PIECE_BYTES + 1)

    def order_lines(self) -> DataFrame:
        header = self.table("orders").select(
            F.col("o_orderkey"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("customer_id"),
        )
        return left_join(self.lines(), header, {"order_id": "o_orderkey"})

    def bikes(self) -> DataFrame:
        words = F.split("p_name", " ")
        return self.table("part").select(
            F.col("p_partkey").alias("bike_id"),
            F.col("p_name").alias("model"),
            F.concat_ws(" - ", "p_type", F.get(words, F.lit(0)), F.get(words, F.lit(1))).alias(
                "description"
            ),
            F.col("p_retailprice").alias("price"),
        )

    def shop_names(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("bikeshop_id"),
            F.col("c_name").alias("bikeshop_name"),
            F.col("c_nationkey").alias("place_id"),
        )

    def places(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.table("region").select("r_regionkey", "r_name")
        return left_join(nation, region, {"n_regionkey": "r_regionkey"}).select(
            F.col("n_nationkey").alias("place_id"), F.concat("n_name", F.lit(", "), "r_name").alias("location")
        )

    def shops(self) -> DataFrame:
        return left_join(self.shop_names(), self.places(), {"place_id": "place_id"}).drop("place_id")

    def sales(self, *columns: str) -> DataFrame:
        """The sales table, or only the given columns of it and the joins they need.

        The keys of these tables are primary keys, hence unique.
        """
        columns = columns or SALES_COLUMNS
        wanted = set(columns)
        lines = self.order_lines() if wanted & {"order_date", *SHOP_COLUMNS} else self.lines()
        bikes = self.bikes() if wanted & PRICED else None
        shops = self.shop_names() if wanted & set(SHOP_COLUMNS) else None
        places = self.places() if wanted & {"city", "state"} else None
        if places is None and shops is not None:
            shops = shops.withColumn("location", F.lit(None).cast("string"))
        return sales_model(lines, bikes, shops, columns, places, unique_keys=True)


def dollars_by(sales: DataFrame, *keys: str | Column) -> DataFrame:
    """Total price per group, in ``sales``.

    A sum of doubles depends in its last digits on the order of addition, which
    differs from run to run; rounding far below a cent keeps reports repeatable.
    """
    return sales.groupBy(*keys).agg(F.round(F.sum("total_price"), 4).alias("sales"))
