"""The category operators on a small sample of car mileages."""

import pytest
from pyspark.sql import functions as F

from spokewise.operators import categories as g
from spokewise.operators.aggregates import box_statistics, count_rows


@pytest.fixture(scope="module")
def mpg(spark):
    rows = [
        ("audi", 1999, "compact", 29),
        ("audi", 2008, "compact", 31),
        ("dodge", 1999, "minivan", 24),
        ("dodge", 2008, "pickup", 19),
        ("dodge", 2008, "pickup", 17),
        ("ford", 1999, "suv", 17),
        ("ford", 2008, "suv", 18),
        ("toyota", 2008, "compact", 37),
        ("toyota", 1999, "suv", 20),
        ("jeep", 2008, "suv", 22),
    ]
    return spark.createDataFrame(rows, "manufacturer string, year int, class string, hwy int")


def names(levels):
    return [r.level for r in levels.orderBy("code").collect()]


def test_classes_by_mileage(mpg):
    assert names(g.levels_by_summary(mpg, "class", "hwy")) == ["pickup", "suv", "minivan", "compact"]
    box = {r["class"]: r for r in box_statistics(mpg, ["class"], "hwy").collect()}
    assert (box["suv"].median, box["suv"].least, box["suv"].greatest) == (19.0, 17.0, 22.0)


def test_makers_by_last_mean(mpg):
    means = mpg.groupBy("manufacturer", "year").agg(F.avg("hwy").alias("mean_hwy"))
    levels = g.levels_by_last(means, "manufacturer", "year", "mean_hwy")
    assert names(levels) == ["toyota", "audi", "jeep", "dodge", "ford"]


def test_reversed_moved_and_lumped(mpg):
    assert names(g.reverse_levels(g.levels_by_value(mpg, "class"))) == ["suv", "pickup", "minivan", "compact"]
    moved = g.relevel(g.levels_by_value(mpg, "class"), ["suv", "compact"])
    assert names(moved) == ["suv", "compact", "minivan", "pickup"]
    # Dodge leads; the three makers with two cars each tie for the second place.
    lumped = count_rows(g.lump(mpg, "manufacturer", 1), "manufacturer", sort=True)
    assert [tuple(r) for r in lumped.collect()] == [("Other", 7), ("dodge", 3)]
    counts = count_rows(g.lump(mpg, "manufacturer", 2), "manufacturer")
    assert {r.manufacturer for r in counts.collect()} == {"audi", "dodge", "ford", "toyota", "jeep"}
