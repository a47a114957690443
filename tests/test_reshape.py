import pytest

from spokewise.operators import reshape as r
from spokewise.plans.summaries import shop_report_to_long, shop_revenue_report


def tuples(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def test_spread(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "key string, value int")
    wide = r.spread(df, [], "key", "value")
    assert wide.columns == ["x", "y"] and tuples(wide) == [(1, 2)]
    shops = spark.createDataFrame(
        [("s", "Road", 1.0), ("s", "Mountain", 2.0), ("t", "Road", 3.0)], "shop string, c string, v double"
    )
    assert tuples(r.spread(shops, ["shop"], "c", "v")) == [("s", 2.0, 1.0), ("t", None, 3.0)]
    with pytest.raises(Exception, match="more than one row for a value of c"):
        r.spread(shops.unionAll(shops), ["shop"], "c", "v", ["Road", "Mountain"]).collect()


@pytest.mark.parametrize("seventh", ["Triathlon", None])
def test_spread_refuses_unlisted_keys(spark, seventh):
    rows = [("s", "Road", 1.0), ("s", seventh, 2.0), ("t", "Road", 3.0)]
    shops = spark.createDataFrame(rows, "shop string, c string, v double")
    with pytest.raises(Exception, match="not listed"):
        r.spread(shops, ["shop"], "c", "v", ["Road"]).collect()
    chosen = r.spread(shops, ["shop"], "c", "v", ["Road"], only_these=True)
    assert tuples(chosen) == [("s", 1.0), ("t", 3.0)]


def test_spread_keeps_a_missing_key(spark):
    df = spark.createDataFrame([(1, 2, 5.0), (1, 10, 6.0), (2, None, 7.0)], "id int, key int, v double")
    wide = r.spread(df, ["id"], "key", "v")
    assert wide.columns == ["id", "2", "10", "<NA>"]
    assert tuples(wide) == [(1, 5.0, 6.0, None), (2, None, None, 7.0)]


def test_gather(spark):
    df = spark.createDataFrame([(1, 3), (2, None)], "a int, b int")
    assert tuples(r.gather(df)) == [("a", 1), ("a", 2), ("b", 3), ("b", None)]
    assert tuples(r.gather(df, ["b"], "k", "v")) == [(1, "b", 3), (2, "b", None)]
    assert tuples(r.gather(df, ids=["a"])) == [(1, "b", 3), (2, "b", None)]


def test_gather_undoes_spread(spark):
    rows = [(i, k, float(i * len(k))) for i in range(4) for k in ("x", "yy")]
    df = spark.createDataFrame(rows, "id int, key string, value double")
    assert tuples(r.gather(r.spread(df, ["id"], "key", "value"), ["x", "yy"])) == sorted(rows, key=str)


def test_money_text_and_back(spark):
    rows = [("a", "Road", 1234.0), ("a", "Mountain", 5.0), ("b", "Road", 7.0)]
    sales = spark.createDataFrame(rows, "bikeshop_name string, category_1 string, total_price double")
    report = shop_revenue_report(sales, ["Mountain", "Road"])
    assert report.columns == ["Bikeshop name", "Mountain", "Road"]
    assert tuples(report) == [("a", "$5", "$1,234"), ("b", None, "$7")]
    assert tuples(shop_report_to_long(report, ["Mountain", "Road"])) == [
        ("a", "Mountain", 5.0),
        ("a", "Road", 1234.0),
        ("b", "Mountain", None),
        ("b", "Road", 7.0),
    ]


def test_zero_fill_and_total(spark):
    df = spark.createDataFrame([("a", 1.0, None)], "k string, x double, y double")
    assert tuples(r.zero_filled_totals(df, ["x", "y"])) == [("a", 1.0, 0.0, 1.0)]
