import datetime as dt
import random
from collections import Counter

import numpy as np

from spokewise.operators.profiles import QUANTILES, full_profile


def by_name(df, **options):
    return {r["column"]: r for r in full_profile(df, **options).collect()}


def test_profile_equals_counting_by_hand(spark):
    rng = random.Random(4)
    # One value holds a third of a column, and long texts differ only at their end.
    rows = [(rng.choice([7.0, rng.random() * 50, None]), "t" * 300 + str(rng.randrange(5)), k % 3 == 0) for k in range(900)]
    found = by_name(spark.createDataFrame(rows, "`a.b` double, t string, l boolean"))
    xs = [r[0] for r in rows if r[0] is not None]
    row = found["a.b"]
    assert (row.rows, row.missing, row.distinct) == (900, 900 - len(xs), len(set(xs)))
    assert np.allclose([row[q] for q in QUANTILES], np.quantile(xs, list(QUANTILES.values())))
    assert row.histogram == np.histogram(xs, 10)[0].tolist()
    assert (found["t"].distinct, found["t"].p50, found["t"].histogram) == (len(Counter(r[1] for r in rows)), None, None)
    assert found["l"].distinct == 2


def test_odd_columns(spark):
    rows = [(2**60, 0.0, None, dt.date(1970, 1, 3), ""), (2**60 + 1, -0.0, None, dt.date(1970, 1, 1), None), (2**60, float("nan"), None, None, "")]
    df = spark.createDataFrame(rows, "k long, z double, n int, d date, e string")
    found = by_name(df, bins=2)
    # Large integers stay apart, zeros do not, NaN is missing, an empty text is a value.
    assert found["k"].distinct == 2 and found["k"].histogram == [3, 0]
    assert (found["z"].distinct, found["z"].missing, found["z"].p100) == (1, 1, 0.0)
    assert (found["n"].missing, found["n"].distinct, found["n"].p0, found["n"].histogram) == (3, 0, None, None)
    assert (found["d"].p0, found["d"].p50, found["d"].p100, found["d"].histogram) == (0.0, 1.0, 2.0, [1, 1])
    assert (found["e"].distinct, found["e"].missing) == (1, 1)
    assert set(by_name(df, columns=["k", "e"])) == {"k", "e"}
    empty = by_name(df.limit(0))
    assert set(empty) == set(df.columns) and {(r.rows, r.missing, r.distinct, r.p50) for r in empty.values()} == {(0, 0, 0, None)}
