import datetime as dt

import pytest
from pyspark.sql import functions as F

from spokewise.plans.sales import clean_order_lines, export_sales, sales_model
from spokewise.session import shared_folder, stage
from spokewise.sources import databases as db
from spokewise.sources import files as f


def tuples(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a,b", 1.5, dt.date(2012, 1, 2)), (2, 'say "x"', None, None), (3, None, -2.0, None)],
        "k bigint, t string, x double, d date",
    )


def test_csv_round_trip(spark, table, tmp_path):
    path = f.join_path(str(tmp_path), "out")
    f.write_csv(table, path)
    assert tuples(f.read_csv(spark, path, table.schema)) == tuples(table)
    assert tuples(f.read_csv(spark, path, "k bigint, t string, x double, d date")) == tuples(table)
    inferred = f.read_csv(spark, path)
    assert [x.dataType.simpleString() for x in inferred.schema] == ["int", "string", "double", "date"]
    f.write_csv(table.limit(1), path)
    assert f.read_csv(spark, path, table.schema).count() == 1


def test_missing_text_is_an_option(spark, table, tmp_path):
    f.write_csv(table.select("k", "t"), str(tmp_path / "out"), missing="-")
    assert f.read_csv(spark, str(tmp_path / "out"), "k bigint, t string").filter("t = '-'").count() == 1
    back = f.read_csv(spark, str(tmp_path / "out"), "k bigint, t string", missing="-")
    assert back.filter("t IS NULL").count() == 1


def test_an_empty_cell_is_missing(spark, tmp_path):
    (tmp_path / "in.csv").write_text('a,b\n,x\nNA,""\n3,NA\n')
    df = f.read_csv(spark, str(tmp_path / "in.csv"), "a int, b string")
    assert [r.a for r in df.collect()] == [None, None, 3]
    assert [r.b for r in df.collect()] == ["x", "", None]


def test_problems_list_bad_rows(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,2.5\nx,3.5\n4,NA\n")
    df = f.read_csv(spark, str(tmp_path / "in.csv"), "a int, b double", keep_bad_rows=True)
    assert [tuple(r) for r in f.problems(df).collect()] == [(None, 3.5, "x,3.5")]
    assert tuples(df.select("a", "b")) == tuples(spark.createDataFrame([(1, 2.5), (None, 3.5), (4, None)], "a int, b double"))
    assert f.problems(df).count() == 1
    fine = f.read_csv(spark, str(tmp_path / "in.csv"), "a string, b double", keep_bad_rows=True)
    assert f.problems(fine).count() == 0


def test_snapshot_keeps_types_and_lists(spark, table, tmp_path):
    folder = str(tmp_path / "root")
    f.write_table(table, f.join_path(folder, "plain.parquet"))
    f.write_table(table, f.join_path(folder, "parted"), ["k"])
    back = f.read_table(spark, f.join_path(folder, "plain.parquet"))
    assert back.schema == table.schema and tuples(back) == tuples(table)
    parted = f.read_table(spark, f.join_path(folder, "parted")).filter("k = 2")
    assert parted.select("t").first()[0] == 'say "x"'
    assert f.list_datasets(spark, folder) == ["parted", "plain"]


def test_refresh_replaces_only_the_given_parts(spark, tmp_path):
    path = str(tmp_path / "years")
    old = spark.range(60).selectExpr("id", "id * 2 AS v", "int(2010 + id % 3) AS year")
    f.write_table(old, path, ["year"])
    files = lambda year: {(x.name, x.stat().st_mtime_ns) for x in (tmp_path / "years" / f"year={year}").glob("*.parquet")}
    before = {y: files(y) for y in (2010, 2011, 2012)}
    new = spark.createDataFrame([(7, -1, 2011), (8, -2, 2013)], "id long, v long, year int")
    f.refresh_table(new, path, ["year"])
    assert files(2010) == before[2010] and files(2012) == before[2012] and not files(2011) & before[2011]
    back = f.read_table(spark, path, old.schema)
    assert tuples(back) == tuples(old.filter("year != 2011").unionAll(new))
    plan = back.filter("year = 2011")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan.split("PartitionFilters")[1]
    # A write that fails half-way changes nothing.
    broken = old.withColumn("v", F.when(F.col("id") < 50, F.col("v")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        f.refresh_table(broken, path, ["year"])
    assert tuples(f.read_table(spark, path, old.schema)) == tuples(old.filter("year != 2011").unionAll(new))
    # Nothing new, and no partition columns.
    f.refresh_table(new.limit(0), path, ["year"])
    assert f.read_table(spark, path, old.schema).count() == 42
    with pytest.raises(ValueError, match="partition"):
        f.refresh_table(new, path, [])


def test_stage_uses_the_shared_folder(spark, table):
    staged = stage(table, "check")
    assert shared_folder(spark) in staged.inputFiles()[0] and tuples(staged) == tuples(table)


def test_views_are_listed_and_lazy(spark, table):
    table.createOrReplaceTempView("album")
    assert "album" in db.list_tables(spark)
    assert spark.table("album").count() == 3


def test_database_settings(spark):
    base = db.Database("jdbc:sqlite:chinook.sqlite", "org.sqlite.JDBC", {"fetchsize": "1000"})
    assert base.settings()["fetchsize"] == "1000"
    assert db.ReadRange("id", 1, 100, 8).settings() == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": "8",
    }
    db.register_database(spark, "chinook", base)
    assert spark.conf.get("spark.sql.catalog.chinook.url") == base.url
    with pytest.raises(Exception, match="(?i)driver|class"):
        db.read_database_table(spark, base, "Album")


def raw_sales(spark):
    bikes = spark.createDataFrame(
        [(1, "Supersix Evo", "Road - Elite Road - Carbon", 12790.0), (2, "Beast", "Mountain - Trail", 10.0)],
        "bike_id bigint, model string, description string, price double",
    )
    shops = spark.createDataFrame(
        [(7, "Ithaca Mountain Climbers", "Ithaca, NY")],
        "bikeshop_id bigint, bikeshop_name string, location string",
    )
    lines = spark.createDataFrame(
        [
            (1, 1, 1, dt.datetime(2011, 1, 7), 7.0, 1.0, 2),
            (2, 1, 2, dt.datetime(2011, 1, 7), 7.0, 2.0, 1),
            (3, 2, 1, dt.datetime(2012, 5, 1), 9.0, 3.0, 1),
        ],
        "i bigint, order_id bigint, order_line bigint, t timestamp, c double, p double, q bigint",
    ).toDF("...1", "order.id", "order line", "Order Date", "customer.id", "product.id", "quantity")
    return clean_order_lines(lines), bikes, shops


def test_sales_model(spark):
    lines, bikes, shops = raw_sales(spark)
    assert lines.columns[0] == "index"
    sales = {(r.order_id, r.order_line): r for r in sales_model(lines, bikes, shops).collect()}
    first = sales[1, 1]
    assert (first.total_price, first.category_2, first.frame_material) == (25580.0, "Elite Road", "Carbon")
    assert (first.city, first.state) == ("Ithaca", "NY")
    assert sales[1, 2].frame_material is None
    # No such shop and no such product: the order line stays.
    assert sales[2, 1].city is None and sales[2, 1].total_price is None
    assert len(sales) == 3


def test_export(spark, tmp_path):
    sales = sales_model(*raw_sales(spark))
    export_sales(sales, str(tmp_path))
    back = f.read_table(spark, f"{tmp_path}/parquet")
    assert tuples(back.select(sales.columns)) == tuples(sales)
    assert sorted(r[0] for r in back.select("order_year").distinct().collect()) == [2011, 2012]
    assert f.read_csv(spark, f"{tmp_path}/csv", sales.schema).count() == 3
    assert back.filter(F.col("order_year") == 2012).count() == 1


def test_rows_of_the_sales_model_do_not_depend_on_columns(spark):
    lines, bikes, shops = raw_sales(spark)
    doubled = bikes.unionAll(bikes)
    counts = {sales_model(lines, doubled, shops, [c]).count() for c in ("order_id", "price", "city")}
    assert len(counts) == 1
    assert sales_model(lines, None, None, ["order_id"], unique_keys=True).count() == 3
