import pytest
from pyspark.sql import functions as F

from spokewise.operators import categories as g


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "low", 5.0, 1), (2, "medium", 1.0, 1), (3, "high", 3.0, 2), (4, "low", 7.0, 2), (5, None, 0.0, 9)]
    return spark.createDataFrame(rows, "k int, c string, v double, x int").repartition(3)


def names(levels):
    rows = levels.orderBy("code").collect()
    assert [r.code for r in rows] == list(range(1, len(rows) + 1))
    return [r.level for r in rows]


def test_level_orders(table):
    assert names(g.levels_by_appearance(table, "c", ["k"])) == ["low", "medium", "high"]
    assert names(g.levels_by_appearance(table, "c", ["x", "v"])) == ["medium", "low", "high"]
    assert names(g.levels_by_value(table, "c")) == ["high", "low", "medium"]
    # Medians: low 6, medium 1, high 3.
    assert names(g.levels_by_summary(table, "c", "v")) == ["medium", "high", "low"]
    assert names(g.levels_by_summary(table, "c", "v", descending=True)) == ["low", "high", "medium"]
    assert names(g.levels_by_summary(table, "c", "v", F.min("v"))) == ["medium", "high", "low"]
    # At the last x: low 7, high 3, medium 1.
    assert names(g.levels_by_last(table, "c", "x", "v")) == ["low", "high", "medium"]
    with pytest.raises(ValueError):
        g.levels_by_appearance(table, "c", ["-k"])


def test_reverse_and_relevel(table):
    levels = g.levels_by_value(table, "c")
    assert names(g.reverse_levels(levels)) == ["medium", "low", "high"]
    assert names(g.relevel(levels, ["medium"])) == ["medium", "high", "low"]
    assert names(g.relevel(levels, ["medium", "low"])) == ["medium", "low", "high"]
    assert names(g.relevel(levels, ["high"], after=1)) == ["low", "high", "medium"]
    assert names(g.relevel(levels, ["high"], after=9)) == ["low", "medium", "high"]
    assert names(g.relevel(levels, ["unknown"])) == ["high", "low", "medium"]


def test_codes(table):
    coded = g.with_codes(table, "c", g.levels_by_value(table, "c"))
    assert [r.c_code for r in coded.orderBy("k").collect()] == [2, 3, 1, 2, None]


def lumped(df, *args, **options):
    rows = g.lump(df, "c", *args, **options).groupBy("c").agg(F.sum("v").alias("v")).collect()
    return {r.c: r.v for r in rows}


def test_lump(spark):
    rows = [("a", 10.0), ("b", 5.0), ("c", 5.0), ("d", 1.0), ("e", 2.0), ("a", 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "c string, v double")
    assert lumped(df, 1, weight="v") == {"a": 11.0, "Other": 13.0, None: 4.0}
    # b and c tie for the second place, so both stay.
    assert lumped(df, 2, weight="v", other="rest") == {"a": 11.0, "b": 5.0, "c": 5.0, "rest": 3.0, None: 4.0}
    # A single value left over keeps its name.
    assert "d" in lumped(df, 4, weight="v")
    assert "Other" not in lumped(df, 9, weight="v")
    # By count, a leads and the other four tie.
    assert lumped(df, 1) == {"a": 11.0, "Other": 13.0, None: 4.0}
    assert "Other" not in lumped(df, 2)
    assert sum(lumped(df, 1, weight="v").values()) == sum(r[1] for r in rows)
    with pytest.raises(ValueError):
        g.lump(df, "c", 0)
    weightless = spark.createDataFrame([("a", 1.0), ("b", None), ("c", None)], "c string, v double")
    assert lumped(weightless, 1, weight="v") == {"a": 1.0, "Other": None}
