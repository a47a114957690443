import pytest
from pyspark.sql import functions as F

from spokewise.operators import columns as c


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 2.0, "b", "c")], "order_id bigint, model string, Price double, city string, x1 string"
    )


def test_helpers(df):
    assert c.starts_with(df, "ORDER") == ["order_id"]
    assert c.ends_with(df, "price") == ["Price"]
    assert c.contains(df, ".") == []
    assert c.contains(df, "IT") == ["city"]
    assert c.matches(df, "^x[0-9]") == ["x1"]
    assert c.num_range(df, "x", range(1, 4)) == ["x1"]
    assert c.any_of(df, ["city", "no"]) == ["city"]
    assert c.last_column(df) == ["x1"]
    assert c.between_columns(df, "model", "city") == ["model", "Price", "city"]
    assert c.between_columns(df, "city", "model") == ["city", "Price", "model"]
    assert c.of_kind(df, "text") == ["model", "city", "x1"]
    assert c.not_of_kind(df, "number") == ["model", "city", "x1"]
    with pytest.raises(ValueError):
        c.all_of(df, ["city", "no"])


def test_pick_and_omit(df):
    assert c.pick(df, "city", c.everything(df)).columns == ["city", "order_id", "model", "Price", "x1"]
    assert c.omit(df, "city", ["x1"]).columns == ["order_id", "model", "Price"]
    assert c.move_first(df, "x1").columns[0] == "x1"
    assert c.one_column(df).columns == ["x1"]
    assert c.one_column(df, "model").columns == ["model"]


def test_renaming(df):
    assert c.rename(df, {"model": "Bike Model"}).columns[1] == "Bike Model"
    with pytest.raises(ValueError):
        c.rename(df, {"no": "x"})
    with pytest.raises(ValueError):
        c.set_names(df, ["a"])
    assert c.rename_with(df, str.upper).columns[0] == "ORDER_ID"
    dotted = c.rename_with(df, lambda n: n.replace("_", ".", 1))
    assert dotted.columns[0] == "order.id"
    assert c.pick(dotted, "order.id").first()[0] == 1
    assert c.set_names(df.select("order_id", "city"), ["a", "b"]).columns == ["a", "b"]


@pytest.mark.parametrize(
    "raw, clean",
    [
        (["...1", "Order ID", "order.id", "%", "2nd"], ["x1", "order_id", "order_id_2", "x", "x2nd"]),
        (["a", "A", "a 2", "a"], ["a", "a_2", "a_2_2", "a_3"]),
        (["bikeShopName", "A  b--c", " a_b_c "], ["bike_shop_name", "a_b_c", "a_b_c_2"]),
    ],
)
def test_clean_names(spark, raw, clean):
    frame = spark.createDataFrame([tuple(range(len(raw)))], [f"c{i}" for i in range(len(raw))])
    assert c.clean_names(frame.toDF(*raw)).columns == clean


def test_report_names():
    assert c.sentence_name("bikeshop_name") == "Bikeshop name"
    assert c.title_name("sales_avg") == "Sales Avg"


def test_added_columns_see_earlier_ones(df):
    row = c.add_columns(df, order_id=F.col("order_id") + 1, twice=F.col("order_id") * 2).first()
    assert (row.order_id, row.twice) == (2, 4)


def test_change_by_kind(df):
    changed = c.change_columns(df, c.of_kind(df, "number"), lambda x: x * 10)
    assert tuple(changed.first()) == (10, "a", 20.0, "b", "c")


def test_overviews(spark, df):
    rows = [tuple(r) for r in c.describe_columns(df).collect()]
    assert rows[0] == (1, "order_id", "bigint")
    frame = spark.createDataFrame([(1.0, "a"), (3.0, None), (None, None)], "x double, t string")
    profile = {r["column"]: r for r in c.profile_columns(frame).collect()}
    assert (profile["x"].rows, profile["x"].missing, profile["x"].mean) == (3, 1, 2.0)
    assert (profile["t"].missing, profile["t"].mean) == (2, None)
