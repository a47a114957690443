"""Figures along a long series: partition by partition, with totals and last rows carried over."""

import decimal
import random
import re

import pytest
from pyspark.sql import functions as F

from oracle import SMALL
from spokewise.operators import long_series as s
from spokewise.operators import windows as w
from spokewise.plans.sales import SalesTables
from spokewise.registered import REGISTERED


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def build(spark, seed=1, missing=0.0, count=240):
    """One date holds a third of all rows; ``k`` is unique."""
    rng = random.Random(seed)
    rows = [
        (k, 7 if rng.random() < 0.33 else rng.randrange(20), rng.choice([None, "a", "b", "c"]), None if rng.random() < missing else rng.randrange(1000) / 4)
        for k in range(count)
    ]
    return spark.createDataFrame(rows, "k int, d int, g string, x double")


def figures(module):
    x = F.col("x")
    if module is s:
        return {
            "total": s.running_sum(x), "mean": s.running_mean(x), "share": s.running_share(x), "first": s.first_value(x), "count": s.running_count(x),
            "lag": s.previous(x, 2), "self": s.previous(F.col("k"), fill_self=True), "roll": s.trailing_mean(x, 30), "sums": s.trailing_sum(x, 4, None),
        }
    return None


def by_window(df, within):
    x, window = F.col("x"), w.series(["-d", "k"], within)
    frame = window.rowsBetween(-3, 0)
    return df.withColumns(
        {
            "total": w.running_sum(x, window), "mean": w.running_mean(x, window), "share": w.running_share(x, window), "first": w.first_value(x, window),
            "count": F.count(x).over(window.rowsBetween(-(1 << 30), 0)), "lag": w.previous(x, window, 2),
            "self": w.previous(F.col("k"), window, fill_self=True), "roll": w.trailing_mean(x, window, 30),
            "sums": F.when(F.row_number().over(window) >= 4, F.when(~F.max(x.isNull()).over(frame), F.sum(x).over(frame))),
        }
    )


def rounded(df):
    out = {}
    for row in df.collect():
        out[row.k] = tuple(round(v, 9) if isinstance(v, float) else v for v in (row[c] for c in sorted(df.columns)))
    return out


@pytest.mark.parametrize("within", [[], ["g"]])
@pytest.mark.parametrize("missing", [0.0, 0.02])
@pytest.mark.parametrize("parts", [1, 5, 60])
def test_equal_to_windows(spark, within, missing, parts):
    df = build(spark, missing=missing)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = s.along(df, ["-d", "k"], within, **figures(s))
        assert found.count() == df.count()
        got = rounded(found)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == rounded(by_window(df, within))


def test_no_step_runs_in_one_partition(spark):
    found = s.along(build(spark), ["d", "k"], **figures(s))
    assert "SinglePartition" not in plan(found)


def test_empty_table_one_row_and_equal_rows(spark):
    df = build(spark)
    assert s.along(df.limit(0), ["d"], **figures(s)).count() == 0
    one = s.along(df.limit(1), ["d"], total=s.running_sum(F.col("x"))).first()
    assert one.total == one.x
    same = spark.createDataFrame([(1, 1.0)] * 50, "d int, x double")
    assert sorted(r.total for r in s.along(same, ["d"], total=s.running_sum(F.col("x"))).collect()) == [float(k) for k in range(1, 51)]


def test_names_with_dots_and_replaced_columns(spark):
    df = build(spark).withColumnsRenamed({"x": "a.x", "g": "the g"})
    found = s.along(df, ["d", "k"], ["the g"], k=s.running_count(F.col("`a.x`")))
    assert found.columns == ["d", "the g", "a.x", "k"]
    assert {r["the g"]: r.n for r in found.groupBy("the g").agg(F.max("k").alias("n")).collect()} == {
        r["the g"]: r["count"] for r in df.groupBy("the g").count().collect()
    }


@pytest.mark.parametrize("name", ["lines_running", "lines_running_by_category", "lines_trailing"])
def test_queries_over_all_lines_stay_spread(spark, name):
    df = REGISTERED[name].build(SalesTables(spark, SMALL))
    assert "SinglePartition" not in plan(df)


@pytest.mark.parametrize("parts", [1, 6])
def test_trailing_figures_of_any_length_and_value(spark, parts):
    """Lengths on both sides of each level; a huge or undefined value leaves no trace once it is out of the frame."""
    rng = random.Random(4)
    odd = {40: 1e300, 41: -1e300, 150: float("inf"), 260: float("nan"), 300: None}
    rows = [(k, k % 2, odd.get(k, rng.randrange(1000) / 4), rng.randrange(1 << 30), decimal.Decimal(k) / 10) for k in range(420)]
    df = spark.createDataFrame(rows, "k int, g int, x double, n int, m decimal(9,1)")
    lengths = (1, 2, 9, 10, 11, 99, 100, 101, 137)
    x, n, m = F.col("x"), F.col("n"), F.col("m")
    figures = {f"x{k}": s.trailing_mean(x, k) for k in lengths} | {f"n{k}": s.trailing_sum(n, k, None) for k in lengths}
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for within in ([], ["g"]):
            got = s.along(df, ["k"], within, m11=s.trailing_sum(m, 11), m10=s.trailing_mean(m, 10), **figures).collect()
            assert len(got) == len(rows)
            for r in got:
                series = [v for v in rows if not within or v[1] == r.g]
                series = series[: next(i for i, v in enumerate(series) if v[0] == r.k) + 1]
                for k in lengths:
                    frame = series[-k:]
                    short, values = len(frame) < k, [v[2] for v in frame]
                    mean = 0.0 if short else None if None in values else sum(values) / k
                    assert r[f"x{k}"] == mean or r[f"x{k}"] == pytest.approx(mean, rel=1e-9, abs=1e285 if 1e300 in values else 0, nan_ok=True)
                    assert r[f"n{k}"] == (None if short else float(sum(v[3] for v in frame)))
                if len(series) >= 11:
                    assert r.m11 == float(sum(v[4] for v in series[-11:])) and r.m10 == pytest.approx(float(sum(v[4] for v in series[-10:])) / 10)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_trailing_figure_costs_no_more_than_its_levels(spark):
    """A sliding frame adds up all its rows again for each row: a thousand times the work."""
    x = F.col("x")
    found = s.along(build(spark), ["d", "k"], short=s.trailing_mean(x, 30), long=s.trailing_mean(x, 1000))
    text = plan(found)
    frames = re.findall(r"specifiedwindowframe\(RowFrame, (-\d+), currentrow", text)
    assert not frames and 20 < text.count("lag(") and text.count("Sort [") <= 2
    with pytest.raises(ValueError):
        s.trailing_sum(x, 0)
