import random

import pytest
from pyspark.sql import functions as F

from spokewise.llm import warc as W

SCHEMA = "record_id long, url string, captured long, kind string, status_code int, headers map<string,string>, status int"


@pytest.mark.parametrize(
    "url, wanted",
    [
        ("http://www.A.example/x/?b=2&utm_source=f&a=1#top", "a.example/x?a=1&b=2"),
        ("https://a.example:443/x", "a.example/x"),
        ("https://a.example", "a.example"),
        ("http://a.example/?ref=1", "a.example"),
        ("not a url", "not a url"),
        (None, None),
    ],
)
def test_canonical_url(spark, url, wanted):
    row = spark.createDataFrame([(url,)], "url string").select(W.canonical_url(F.col("url")).alias("k")).first()
    assert row.k == wanted


@pytest.mark.parametrize("block", [7, 3600, 10**9])
def test_latest_earlier_equals_search_by_hand(spark, block):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "a", "a", "b", None]), rng.randrange(200), rng.random() < 0.4) for k in range(400)]
    found = W.latest_earlier(spark.createDataFrame(rows, "id long, url_key string, captured long, is_response boolean"), block)
    found = {r.revisit_id: r.response_id for r in found.collect()}
    for i, key, at, response in rows:
        if not response and key is not None:
            before = [(t, k) for k, u, t, full in rows if full and u == key and t < at]
            assert found[i] == (max(before)[1] if before else None)


def test_validators_and_headers(spark):
    full = {"etag": '"1"', "last-modified": "m", "content-length": "9", "server": "s"}
    rows = [
        (1, "http://a/x", 10, "response", 200, full, 0),
        (2, "https://www.a/x/", 20, "revisit", 304, {"etag": 'W/"1"', "date": "d", "content-length": "0", "server": "t"}, 0),
        (3, "http://a/x", 20, "revisit", 304, {"etag": '"2"'}, 0),
        (4, "http://a/x", 20, "revisit", 304, {"last-modified": "m"}, 0),
        (5, "http://a/x", 20, "revisit", 304, None, 0),
        (6, "http://a/x", 10, "revisit", 304, {}, 0),
        (7, None, 20, "revisit", 304, {}, 0),
        (8, "http://a/x", None, "revisit", 304, {}, 0),
        (9, "http://a/x", 15, "response", 404, {"etag": '"9"'}, 0),
        (5, "http://a/x", 20, "revisit", 304, None, 0),
    ]
    found = W.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    by_id = {r.record_id: r for r in found}
    assert {k: r.status for k, r in by_id.items()} == {
        2: "resolved", 3: "changed", 4: "resolved", 5: "unverified", 6: "orphan", 7: "orphan", 8: "orphan"
    }
    assert by_id[2].headers == {"etag": 'W/"1"', "last-modified": "m", "content-length": "9", "server": "t", "date": "d"}
    assert by_id[4].response_id == 1 and by_id[3].headers is None and by_id[6].response_id is None
    assert sum(r.record_id == 5 for r in found) == 2
    assert W.resolve_revisits(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


def test_copies_of_records_do_not_multiply(spark):
    tags = [{"etag": '"1"', "server": "b"}, {"etag": '"1"', "server": "a"}]
    rows = [(1, "http://a/x", 10, "response", 200, tags[k % 2], 0) for k in range(40)]
    rows += [(1, "http://a/y", 10, "response", 200, {"etag": '"y"'}, 0)]
    rows += [(2, "http://a/x", 20, "revisit", 304, {"etag": '"1"'}, 0)] * 30
    rows += [(2, "http://a/y", 30, "revisit", 304, {"etag": '"y"'}, 0), (2, "http://a/z", 30, "revisit", 304, None, 0)]
    found = W.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 32
    assert {(r.url, r.status, r.headers and r.headers.get("server")) for r in found} == {
        ("http://a/x", "resolved", "a"), ("http://a/y", "resolved", None), ("http://a/z", "orphan", None)
    }


def test_very_long_headers_are_carried_whole(spark):
    rows = [
        (1, "http://a/" + "p" * 200_000, 10, "response", 200, {"etag": '"1"', "server": "s" * 1_000_000}, 0),
        (2, "http://a/" + "p" * 200_000, 20, "revisit", 304, {"etag": '"1"'}, 0),
    ]
    (row,) = W.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert row.status == "resolved" and len(row.headers["server"]) == 1_000_000


def test_repeated_pages_give_their_revisits_in_both_engines(spark, tmp_path):
    import duckdb

    from spokewise.llm import queries

    pages = [(3, "http://a.example/x", "<p>x</p>")] * 4 + [(4, "http://a.example/y", "<p>y</p>"), (5, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.QUERIES["op3_warc_revisits"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cursor = con.execute(queries.SQL["op3_warc_revisits"])
    names = [d[0] for d in cursor.description]
    wanted = sorted((tuple(dict(zip(names, r))[n] for n in found[0].asDict()) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(r) for r in found), key=str) == wanted
    assert sum(r.record_id in (13, 14) for r in found) == 8
