"""Summaries, above all exact quantiles against numpy on skewed groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spokewise.operators import aggregates as a

PROBS = {"least": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.93, "greatest": 1.0}


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(3)
    data = {
        "hot": [rng.gauss(0, 1) for _ in range(3000)],
        "ties": [float(rng.choice([1, 1, 1, 2, 9])) for _ in range(500)],
        "one": [4.0],
        "two": [1.0, 2.0],
        None: [float(i) for i in range(50)],
        "wide": [10.0**i for i in range(-20, 20)],
    }
    return data


@pytest.fixture(scope="module")
def table(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    rows += [("hot", None), ("two", None), ("empty", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


def test_quantiles_are_exact(table, groups):
    found = {r.g: r for r in a.quantiles(table, ["g"], "v", PROBS).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        for name, p in PROBS.items():
            assert found[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12), (g, name)


def test_quantiles_of_the_whole_table(table, groups):
    values = [v for group in groups.values() for v in group]
    row = a.quantiles(table, [], "v", PROBS).first()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_values_are_ranked_in_many_tasks(table):
    plan = a._ranked(a._weighed(table, [], "v"), [])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_strict_and_lenient(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "g string, v double")
    v = F.col("v")
    for make in (a.total, a.mean, a.minimum, a.maximum):
        strict = {r.g: r.s for r in a.summarise(df, ["g"], s=make(v)).collect()}
        lenient = {r.g: r.s for r in a.summarise(df, ["g"], s=make(v, na_rm=True)).collect()}
        assert strict == {"a": None, "b": 2.0} and lenient == {"a": 1.0, "b": 2.0}
    assert a.summarise(df.filter("g = 'b'"), s=a.deviation(v)).first()[0] is None
    assert {r.g: r.m for r in a.medians(df, ["g"], "v", "m").collect()} == {"a": None, "b": 2.0}
    assert {r.g: r.m for r in a.medians(df, ["g"], "v", "m", na_rm=True).collect()} == {"a": 1.0, "b": 2.0}


def test_grouped_mean(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), (None, 4)], "group string, score int")
    means = {r.group: r.avg for r in a.summarise(df, ["group"], avg=a.mean(F.col("score"))).collect()}
    assert means == {"A": 1.5, "B": 3.0, None: 4.0}


def test_six_statistics(table, groups):
    found = {r.g: r for r in a.six_statistics(table, ["g"], "v").collect()}
    assert found["one"].sd_v is None and found["one"].avg_v == 4.0
    assert found["ties"].sd_v == pytest.approx(np.std(groups["ties"], ddof=1))
    assert found["hot"].avg_v == pytest.approx(np.mean(groups["hot"]))
    whole = a.six_statistics(table, [], "v").first()
    assert whole["count"] == table.count() and whole.sd_v is None
    assert found["two"]["count"] == 3 and found["two"].median_v == 1.5
    assert found["two"].sd_v is None and found["two"].min_v is None
    assert found[None].sd_v == pytest.approx(np.std(groups[None], ddof=1))
    assert found["empty"]["count"] == 1 and found["empty"].median_v is None


def test_missing_share(table):
    share = a.missing_share(table.filter("g = 'two'")).first()
    assert share.v == pytest.approx(1 / 3) and share.g == 0


def test_bands(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 10)] + [(None,)], "v double")
    bands = {r.v: r.band for r in a.quantile_bands(df, "v").collect()}
    assert bands[9.0] == bands[8.0] == "High" and bands[7.0] == "Medium"
    assert bands[3.0] == "low" and bands[4.0] == "Medium" and bands[None] == "low"


def test_trend(spark):
    rows = [("up", x, 2.0 * x + 1) for x in range(5)] + [("one", 3, 7.0)]
    df = spark.createDataFrame(rows, "g string, x int, y double")
    trend = {r.g: r for r in a.linear_trend(df, "x", "y", ["g"]).collect()}
    assert (trend["up"].slope, trend["up"].intercept) == pytest.approx((2, 1))
    assert trend["one"].slope is None
    fitted = a.with_trend(df.filter("g = 'up'"), "x", "y").collect()
    assert all(r.fitted == pytest.approx(r.y) for r in fitted)


def test_box(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None)], "g string, v double")
    box = a.box_statistics(df, ["g"], "v").first()
    assert (box.q1, box.median, box.q3) == tuple(np.quantile(values, [0.25, 0.5, 0.75]))
    assert (box.whisker_low, box.whisker_high, box.outliers, box.greatest) == (1.0, 5.0, 1, 100.0)
    whole = a.box_statistics(df, [], "v").first()
    assert (whole.median, whole.outliers) == (box.median, 1)
