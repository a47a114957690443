import datetime as dt

import pytest
from pyspark.sql import functions as F

from spokewise.operators import joins as j
from spokewise.operators import rows as r
from spokewise.operators.aggregates import count_rows
from spokewise.operators.ordering import sort_by_code
from spokewise.plans.series import orders_between


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame([("A", 1.0), ("A", 1.0), ("B", 2.0)], "name string, score double")


def tuples(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def test_filters(scores):
    assert r.keep_rows(scores, F.col("score") > 1, F.col("name") == "B").count() == 1
    assert r.keep_rows(scores).count() == 3
    assert tuples(r.above_mean(scores, "score")) == [("B", 2.0)]


def test_missing_values_in_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert tuples(r.keep_rows(df, F.col("x") != "a")) == [("b",)]
    assert tuples(r.keep_rows(df, r.not_in(F.col("x"), ["a"]))) == [("b",), (None,)]
    assert tuples(r.present(df, "x")) == [("a",), ("b",)]


def test_distinct(scores):
    assert tuples(r.distinct_rows(scores)) == [("A", 1.0), ("B", 2.0)]
    assert tuples(r.distinct_rows(scores, "name")) == [("A",), ("B",)]


def test_count(scores):
    assert [tuple(x) for x in count_rows(scores, "name", sort=True).collect()] == [("A", 2), ("B", 1)]


def test_sort_by_code(spark):
    months = spark.createDataFrame([("Feb", 2), ("Jan", 1)], "month string, month_code int")
    assert [x.month for x in sort_by_code(months, "month").collect()] == ["Jan", "Feb"]
    assert [x.month for x in sort_by_code(months, "month", True).collect()] == ["Feb", "Jan"]


def test_date_range_includes_both_ends(spark):
    df = spark.createDataFrame(
        [(1, "2011-12-31 23:59:59"), (2, "2012-01-01"), (3, "2013-01-01 18:00:00"), (4, "2013-01-02")],
        "k int, t string",
    ).select("k", F.col("t").cast("timestamp_ntz").alias("order_date"))
    found = orders_between(df, dt.date(2012, 1, 1), dt.date(2013, 1, 1))
    assert tuples(found) == [(2, dt.date(2012, 1, 1)), (3, dt.date(2013, 1, 1))]


def test_left_join(spark):
    a = spark.createDataFrame([(1, "A"), (2, "B"), (None, "C")], "id int, name string")
    b = spark.createDataFrame([(1, 10), (1, 11), (None, 99)], "id int, score int")
    assert tuples(j.left_join(a, b, ["id"])) == [
        (1, "A", 10),
        (1, "A", 11),
        (2, "B", None),
        (None, "C", None),
    ]
    assert (None, "C", 99) in tuples(j.left_join(a, b, ["id"], na_matches=True))
    renamed = j.left_join(a, b.withColumnRenamed("id", "key"), {"id": "key"})
    assert renamed.columns == ["id", "name", "score"]


def test_repeated_keys(spark):
    b = spark.createDataFrame([(1, 10), (1, 11), (2, 99)], "id int, score int")
    assert tuples(j.repeated_keys(b, "id")) == [(1, 2)]


def test_cast_keys(spark):
    df = spark.createDataFrame([("7",), ("x",)], "id string")
    assert tuples(j.cast_keys(df, "id")) == [(7,), (None,)]


def test_binds(spark):
    x = spark.createDataFrame([(2,), (1,)], "x int")
    y = spark.createDataFrame([(4,), (3,)], "y int")
    assert tuples(j.bind_columns(x, y, ["x"], ["y"])) == [(1, 3), (2, 4)]
    assert tuples(j.bind_columns(x, y, ["x"], ["-y"])) == [(1, 4), (2, 3)]
    with pytest.raises(ValueError):
        j.bind_columns(x, y.limit(1), ["x"], ["y"])
    with pytest.raises(ValueError):
        j.bind_columns(x, x, ["x"], ["x"])
    assert tuples(j.bind_rows(x, x, y)) == [
        (1, None), (1, None), (2, None), (2, None), (None, 3), (None, 4),
    ]


def test_names_on_both_sides_of_a_join_get_suffixes(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "c")], "key int, v string")
    joined = j.left_join(left, right, {"k": "key"})
    assert joined.columns == ["k", "v.x", "v.y"]
    assert sorted(map(tuple, joined.collect())) == [(1, "a", "c"), (2, "b", None)]
    with pytest.raises(ValueError):
        j.left_join(joined.withColumnRenamed("v.y", "v"), right, {"k": "key"})


def test_dotted_names(spark):
    from spokewise.operators.aggregates import quantiles
    from spokewise.operators.categories import levels_by_value, with_codes
    from spokewise.operators.ordering import sort_rows
    from spokewise.operators.rows import present
    from spokewise.functions.text import separate, unite

    df = spark.createDataFrame([(2, "a b"), (1, "c d"), (None, "a b")], "`order.id` int, `t.x` string")
    assert [r[0] for r in sort_rows(df, "-order.id").collect()] == [2, 1, None]
    assert present(df, "order.id").count() == 2
    assert separate(df, "t.x", ["p", "q"]).columns == ["order.id", "p", "q"]
    assert unite(df, "u", ["order.id", "t.x"]).columns == ["u"]
    assert j.left_join(df, df, ["order.id"]).columns == ["order.id", "t.x.x", "t.x.y"]
    assert with_codes(df, "t.x", levels_by_value(df, "t.x"), "code").count() == 3
    assert {r[0]: r.q for r in quantiles(df, ["t.x"], "order.id", {"q": 0.5}).collect()} == {"a b": 2.0, "c d": 1.0}
