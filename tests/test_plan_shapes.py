"""What the physical plans must look like to hold at scale."""

import re

import pytest

from oracle import SMALL
from spokewise.operators import positions as p
from spokewise.operators.joins import left_join
from spokewise.operators.rows import above_mean
from spokewise.plans.sales import SalesTables
from spokewise.plans.series import orders_between, sales_by_year
from spokewise.registered import REGISTERED


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    return set(re.findall(r"/(\w+)\.parquet", plan(df)))


def columns_read(df, table):
    found = [x for x in plan(df).splitlines() if f"/{table}.parquet" in x]
    return set(re.findall(r"[\[,](\w+)#", found[0].split("Batched")[0]))


@pytest.fixture(scope="module")
def tables(spark):
    return SalesTables(spark, SMALL)


def test_only_needed_tables_are_joined(tables):
    assert scanned(tables.sales("quantity", "total_price")) == {"lineitem", "part"}
    assert scanned(tables.sales("order_date", "total_price")) == {"lineitem", "part", "orders"}
    assert scanned(tables.sales("order_id", "quantity")) == {"lineitem"}
    assert scanned(tables.sales("city")) == {"lineitem", "orders", "customer", "nation", "region"}


def test_only_needed_columns_are_read(tables):
    yearly = sales_by_year(tables.sales("order_date", "total_price"))
    assert columns_read(yearly, "lineitem") == {"l_orderkey", "l_partkey", "l_quantity"}
    assert columns_read(yearly, "part") == {"p_partkey", "p_retailprice"}


def test_sums_are_partial_before_the_shuffle(tables):
    assert "partial_sum" in plan(tables.sales("category_1", "total_price").groupBy("category_1").sum())


def test_date_range_reaches_the_scan(tables):
    import datetime as dt

    sales = tables.sales("order_date", "order_id", "quantity")
    text = plan(orders_between(sales, dt.date(1996, 1, 1), dt.date(1997, 1, 1)))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_a_cut_is_a_filter_without_shuffle(tables, monkeypatch):
    monkeypatch.setattr(p, "SHORT_RANGE", 0)
    train, _ = p.split_at(tables.lines(), list(SalesTables.LINE_KEY), 3000)
    assert "Exchange" not in plan(train)
    assert "LessThanOrEqual(l_orderkey" in plan(train)
    buckets = p.equal_buckets(tables.lines(), "list_amount", 3, ["order_id"])
    assert "Exchange" not in plan(buckets)


def test_short_slices_use_a_top_k_sort(tables):
    assert "TakeOrderedAndProject" in plan(p.slice_rows(tables.lines(), ["order_id"], 1, 5))
    assert "TakeOrderedAndProject" in plan(p.last_rows(tables.lines(), ["order_id"], 5))


def test_comparison_with_the_mean_is_a_scalar_subquery(tables):
    text = plan(above_mean(tables.bikes().select("bike_id", "price"), "price"))
    assert "Subquery" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_large_sides_are_not_broadcast(spark, tables):
    """With the size limit below the tables, every join shuffles both sides."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        joined = left_join(tables.lines(), tables.table("orders"), {"order_id": "o_orderkey"})
        assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)
        assert "Broadcast" not in plan(tables.sales())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


LAZY = [
    "sales_by_year",
    "sales_by_year_category_trend",
    "revenue_by_trio",
    "monthly_rolling",
    "shop_category_report",
    "model_features",
    "price_by_base_model_report",
    "dollar_text",
    "statement_text",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python_rows(tables, name):
    text = plan(REGISTERED[name].build(tables))
    for word in ("NestedLoop", "Cartesian", "Python", "Pandas"):
        assert word not in text


def test_row_wise_features_are_one_stage(tables):
    assert "Exchange" not in plan(REGISTERED["model_features"].build(tables))


def test_partitioned_write_is_rebalanced(spark, tables, tmp_path):
    hinted = tables.lines().hint("rebalance", "order_line")
    assert "RebalancePartitions" in hinted._jdf.queryExecution().optimizedPlan().toString()


def test_a_hot_join_key_is_split(spark):
    """A third of the rows share one key; no task may get them all."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 60_000, 1, 8)
        lines = ids.selectExpr("id AS line", "if(id % 3 = 0, 7, id % 997) AS product_id")
        products = spark.range(1000).selectExpr("id AS bike_id", "id * 1.5 AS price")
        joined = left_join(lines, products, {"product_id": "bike_id"})
        assert len(joined.collect()) == 60_000
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_staged_tables_are_freed(spark):
    from spokewise.session import stage, staging

    with pytest.raises(ValueError):
        with staging(spark):
            table = stage(spark.range(1000), "freed")
            assert table.count() == 1000
            path = table.inputFiles()[0].rsplit("/", 1)[0]
            raise ValueError
    assert spark.read.parquet(path).count() == 0


def test_shop_joins_do_not_shuffle_order_lines_by_shop(spark):
    from spokewise.plans.sales import SalesTables

    sales = SalesTables(spark, "/root/testdata/sf0.1").sales("order_id", "bikeshop_name", "city")
    sales.write.format("noop").mode("overwrite").save()
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id" not in plan
