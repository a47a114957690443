import numpy as np
import pytest
from pyspark.sql import functions as F

from spokewise.operators import windows as w


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(y, m, float((y - 2000) * 100 + m * m)) for y in (2001, 2002) for m in range(1, 6)]
    return spark.createDataFrame(rows[::-1], "y int, m int, s double")


def column(df, expression):
    return [r[0] for r in df.withColumn("out", expression).orderBy("y", "m").select("out").collect()]


def test_lag_and_change(sales):
    window = w.series(["y", "m"])
    values = column(sales, F.col("s"))
    assert column(sales, w.previous(F.col("s"), window)) == [None, *values[:-1]]
    assert column(sales, w.previous(F.col("s"), window, fill_self=True)) == [values[0], *values[:-1]]
    changed = w.with_change(sales, "s", ["y", "m"]).orderBy("y", "m").collect()
    assert changed[0].pct_diff == 0
    # Not restarted at the new year.
    assert changed[5].pct_diff == pytest.approx((values[5] - values[4]) / values[4])
    within = w.with_change(sales, "s", ["m"], within=["y"]).orderBy("y", "m").collect()
    assert within[5].pct_diff == 0


def test_zero_base_gives_null(spark):
    assert spark.range(1).select(w.relative_change(F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_first_and_running(sales):
    window, values = w.series(["y", "m"]), column(sales, F.col("s"))
    assert set(column(sales, w.first_value(F.col("s"), window))) == {values[0]}
    yearly = column(sales, w.first_value(F.col("s"), w.series(["m"], ["y"])))
    assert yearly == [values[0]] * 5 + [values[5]] * 5
    assert column(sales, w.running_sum(F.col("s"), window)) == list(np.cumsum(values))
    means = np.cumsum(values) / np.arange(1, 11)
    assert column(sales, w.running_mean(F.col("s"), window)) == pytest.approx(means)
    share = column(sales, w.running_share(F.col("s"), w.series(["m"], ["y"])))
    assert share[4] == share[9] == 1


def test_running_stops_at_a_missing_value(sales):
    holed = sales.withColumn("s", F.when(~((F.col("y") == 2001) & (F.col("m") == 3)), F.col("s")))
    window = w.series(["y", "m"])
    assert column(holed, w.running_sum(F.col("s"), window))[2:] == [None] * 8
    assert column(holed, w.running_share(F.col("s"), window)) == [None] * 10
    rolled = column(holed, w.trailing_mean(F.col("s"), window, 2))
    assert rolled[0] == 0 and rolled[2:4] == [None, None] and rolled[4] is not None


@pytest.mark.parametrize("length", [1, 2, 3, 6, 20])
@pytest.mark.parametrize("fill", [0.0, None])
def test_trailing(sales, length, fill):
    window, values = w.series(["y", "m"]), column(sales, F.col("s"))

    def by_hand(summary):
        return [
            fill if i + 1 < length else summary(values[i + 1 - length : i + 1])
            for i in range(len(values))
        ]

    assert column(sales, w.trailing_mean(F.col("s"), window, length, fill)) == pytest.approx(by_hand(np.mean))
    assert column(sales, w.trailing_median(F.col("s"), window, length, fill)) == pytest.approx(
        by_hand(np.median)
    )
