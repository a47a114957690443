"""Row positions, on the short path and on the staged path for long ranges."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from spokewise.operators import positions as p
from spokewise.operators.ordering import sort_rows
from spokewise.registered.registry import REGISTERED
from spokewise.plans.sales import SalesTables
from oracle import SMALL, connect, differences


@pytest.fixture(scope="module")
def rows(spark):
    """200 rows; one value of ``x`` holds a third of them, some are NULL; ``k`` is unique."""
    rng = random.Random(7)
    data = []
    for k in range(200):
        x = None if k % 17 == 0 else 5.0 if k % 3 == 0 else float(rng.randrange(12))
        data.append((x, k))
    rng.shuffle(data)
    return data


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "x double, k bigint").repartition(6)


@pytest.fixture(params=["short", "long"])
def path(request, monkeypatch):
    if request.param == "long":
        monkeypatch.setattr(p, "SHORT_RANGE", 0)
    return request.param


def in_order(rows, down=False):
    sign = -1 if down else 1
    return sorted(rows, key=lambda r: (r[0] is None, sign * (r[0] or 0), r[1]))


def as_tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("order, down", [(["x", "k"], False), (["-x", "k"], True)])
@pytest.mark.parametrize("start, stop", [(1, 1), (1, 70), (71, 200), (60, 130), (199, 500), (300, 400)])
def test_slice(table, rows, path, order, down, start, stop):
    wanted = in_order(rows, down)[start - 1 : stop]
    assert sorted(as_tuples(p.slice_rows(table, order, start, stop)), key=lambda r: r[1]) == sorted(
        wanted, key=lambda r: r[1]
    )


def test_slice_rejects_a_bad_range(table):
    for start, stop in ((0, 3), (4, 3)):
        with pytest.raises(ValueError):
            p.slice_rows(table, ["k"], start, stop)


@pytest.mark.parametrize("cut", [1, 96, 199, 200, 250])
def test_split_is_disjoint_and_whole(table, rows, path, cut):
    train, test = p.split_at(table, ["x", "k"], cut)
    ordered = in_order(rows)
    assert sorted(r.k for r in train.collect()) == sorted(r[1] for r in ordered[:cut])
    assert sorted(r.k for r in test.collect()) == sorted(r[1] for r in ordered[cut:])


def test_cut_between_equal_rows_still_counts_right(table, path):
    """The order is not unique here, so no key value can mark the cut."""
    train, test = p.split_at(table, ["x"], 96)
    assert (train.count(), test.count()) == (96, 104)
    assert p.slice_rows(table, ["x"], 50, 149).count() == 100
    blanked = p.null_first_rows(table.withColumn("y", F.lit(1)), "y", ["x"], 40)
    assert blanked.filter("y IS NULL").count() == 40


def test_row_index(table, rows):
    indexed = p.row_index(table, ["x", "k"])
    found = [r.k for r in indexed.orderBy("row_index").collect()]
    assert found == [r[1] for r in in_order(rows)]
    assert sorted(r.row_index for r in indexed.collect()) == list(range(1, 201))


def test_no_rows(spark, table):
    none = table.filter("k < 0")
    assert p.row_index(none, ["k"]).count() == 0
    assert p.equal_buckets(none, "x", 3, ["k"]).count() == 0
    assert p.last_rows(none, ["k"]).count() == 0


def test_last_rows_and_ties(table, rows):
    assert as_tuples(p.last_rows(table, ["x", "k"])) == in_order(rows)[-6:]
    assert as_tuples(p.last_rows(table, ["-x", "k"], 10)) == in_order(rows, down=True)[-10:]
    assert as_tuples(p.first_rows(table, ["-x", "k"], 3)) == in_order(rows, down=True)[:3]


def test_blank_first_rows(table, rows, path):
    blanked = p.null_first_rows(table.withColumn("y", F.lit(1)), "y", ["x", "k"], 70)
    found = {r.k for r in blanked.filter("y IS NULL").collect()}
    assert found == {r[1] for r in in_order(rows)[:70]}


def buckets_by_hand(rows, count):
    ordered = [r for r in in_order(rows) if r[0] is not None]
    size, longer = divmod(len(ordered), count)
    labels, at = {}, 0
    for i in range(count):
        step = size + (i < longer)
        labels.update({r[1]: i + 1 for r in ordered[at : at + step]})
        at += step
    return {r[1]: labels.get(r[1]) for r in rows}


@pytest.mark.parametrize("count", [1, 2, 3, 7, 300])
def test_equal_buckets(table, rows, count):
    found = {r.k: r.bucket for r in p.equal_buckets(table, "x", count, ["k"]).collect()}
    assert found == buckets_by_hand(rows, count)


def test_equal_buckets_with_equal_keys_have_the_right_sizes(table, rows):
    sizes = {
        r.bucket: r["count"]
        for r in p.equal_buckets(table.select("x"), "x", 3, []).groupBy("bucket").count().collect()
    }
    wanted = buckets_by_hand(rows, 3)
    assert sizes == {b: list(wanted.values()).count(b) for b in (1, 2, 3, None)}


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 1000), st.integers(1, 40))
def test_bucket_ends(count, buckets):
    ends = p.bucket_ends(count, buckets)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == count and max(sizes) - min(sizes) <= 1
    assert sizes == sorted(sizes, reverse=True)


def test_sort_puts_missing_last_both_ways(table):
    for key in ("x", "-x"):
        found = [r.x for r in sort_rows(table, key).collect()]
        assert all(v is None for v in found[-12:]) and found[0] is not None


@pytest.mark.parametrize(
    "name", ["slice_range", "train_test_union", "blanked_first_rows", "row_positions", "price_ntile"]
)
def test_queries_on_the_staged_path(spark, monkeypatch, name):
    monkeypatch.setattr(p, "SHORT_RANGE", 0)
    df = REGISTERED[name].build(SalesTables(spark, SMALL))
    assert differences(df, connect(SMALL), REGISTERED[name].sql) == ""


def test_timestamps_without_zone_work_as_cut_keys(spark, monkeypatch):
    monkeypatch.setattr(p, "SHORT_RANGE", 0)
    orders = SalesTables(spark, SMALL).table("orders").select("o_orderdate", "o_orderkey")
    train, test = p.split_at(orders, ["-o_orderdate", "o_orderkey"], 500)
    assert train.count() == 500
    assert train.agg(F.min("o_orderdate")).first()[0] >= test.agg(F.max("o_orderdate")).first()[0]


def test_timestamps_survive_a_repeated_clock_hour(spark, monkeypatch):
    """Two moments an hour apart that read the same on a New York clock."""
    monkeypatch.setattr(p, "SHORT_RANGE", 0)
    first = 1762061400  # 2025-11-02 01:30 before the clocks go back
    seconds = [first - 3600, first, first + 3600, first + 7200]
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(
        "s", F.timestamp_seconds("s").alias("t")
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for cut in (1, 2, 3):
            head, _ = p.split_at(df, ["t"], cut)
            assert sorted(r.s for r in head.select("s").collect()) == seconds[:cut]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_numbers_and_nan_as_keys(spark, path):
    nan = float("nan")
    df = spark.createDataFrame([(nan,), (nan,), (1.0,), (None,), (None,)], "x double")
    for cut in range(1, 5):
        head, rest = p.split_at(df, ["x"], cut)
        assert (head.count(), rest.count()) == (cut, 5 - cut)


def test_long_heads_and_tails(table, rows, monkeypatch):
    monkeypatch.setattr(p, "SHORT_RANGE", 5)
    assert as_tuples(p.last_rows(table, ["x", "k"], 50)) == in_order(rows)[-50:]
    assert as_tuples(p.last_rows(table, ["x", "k"], 500)) == in_order(rows)
    assert as_tuples(p.first_rows(table, ["-x", "k"], 50)) == in_order(rows, down=True)[:50]


def test_ties_fall_alike_whatever_the_position(spark, monkeypatch):
    df = spark.createDataFrame([(k // 7, k) for k in range(60)], "v int, k int").repartition(4)
    short = sorted(r.k for r in p.slice_rows(df, ["v"], 1, 10).collect())
    monkeypatch.setattr(p, "SHORT_RANGE", 0)
    assert sorted(r.k for r in p.slice_rows(df, ["v"], 1, 10).collect()) == short
    first, rest = p.split_at(df, ["v"], 10)
    assert sorted(r.k for r in first.collect()) == short and rest.count() == 50
