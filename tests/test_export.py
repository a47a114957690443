"""Exports of the sales table in pieces: all rows, and little disk."""

import datetime as dt
import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle import differences
from spokewise.plans import sales as s
from spokewise.registered import REGISTERED
from spokewise.session import freed_shuffles
from spokewise.sources import files as f

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tuples(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {x for d in folders for _, _, names in os.walk(d.getPath()) for x in names if x.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files beyond those of before; they are deleted in the background."""
    for _ in range(50):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return found


@pytest.fixture
def sales(spark):
    """A few rows for each order, some of them twice, and orders without a date or a number."""
    ids = spark.range(900).selectExpr("if(id % 9 = 0, null, id div 3) AS order_id", "id % 2 AS order_line", "id")
    day = F.when(F.col("id") % 7 > 0, F.expr("make_timestamp(2011 + id % 4, 1, 7, 12, 0, 0)"))
    model = F.when(F.col("id") % 5 > 0, F.concat(F.lit('a,"b" '), F.col("id").cast("string")))
    once = ids.select(day.alias("order_date"), "order_id", "order_line", model.alias("model"))
    return once.unionAll(once.filter("order_id % 10 = 0 OR order_id IS NULL"))


@pytest.mark.parametrize("pieces", [1, 3])
def test_export_has_all_rows_and_keeps_no_shuffles(spark, sales, tmp_path, pieces):
    # The joined side has all keys of the sales; no broadcast, so there are shuffles to free.
    names = spark.range(310).selectExpr("id AS order_id", "concat('shop ', id) AS shop").hint("merge")
    joined = sales.join(names, "order_id", "left")
    wanted, before = tuples(joined), shuffle_files(spark)
    s.export_sales(joined, str(tmp_path), pieces)
    assert left_over(spark, before) == set()
    assert spark.conf.get(FREED, None) is None
    back = f.read_table(spark, f"{tmp_path}/parquet")
    assert tuples(back.select(joined.columns)) == wanted
    assert tuples(f.read_csv(spark, f"{tmp_path}/csv", joined.schema)) == wanted
    assert {x.order_year for x in back.select("order_year").distinct().collect()} == {None, 2011, 2012, 2013, 2014}
    files = [x.name for x in (tmp_path / "csv").iterdir() if x.name[0] not in "._"]
    assert files and all(x.endswith(".csv.gz") for x in files)
    # Each piece is a write of its own, and none has nearly all rows.
    write = F.regexp_extract(F.input_file_name(), r"part-\d+-([0-9a-f-]{36})", 1)
    rows = [x["count"] for x in back.groupBy(write.alias("write")).count().collect()]
    assert len(rows) == pieces and max(rows) <= len(wanted) * (1 if pieces == 1 else 0.5)


def test_compressed_files_are_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(f, "COMPRESSED_ROWS", 40)
    table = spark.range(0, 100, 1, 1).selectExpr("id", "concat('x', id) AS t")
    f.write_csv(table, str(tmp_path / "gz"), compression="gzip")
    f.write_csv(table, str(tmp_path / "plain"))
    assert len(list((tmp_path / "gz").glob("part*.csv.gz"))) == 3
    assert len(list((tmp_path / "plain").glob("part*.csv"))) == 1
    for name in ("gz", "plain"):
        assert tuples(f.read_csv(spark, str(tmp_path / name), table.schema)) == tuples(table)


def test_pieces_replace_the_table_and_are_marked_when_whole(spark, tmp_path):
    path, old = str(tmp_path / "t"), spark.range(50).selectExpr("id AS `k.1`", "1 AS v", "int(id % 3) AS year")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        f.write_table(old.withColumn("year", F.lit(9)), path, ["year"], 2, "k.1")
        f.write_table(old, path, ["year"], 4, "k.1")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert tuples(f.read_table(spark, path, old.schema)) == tuples(old) and (tmp_path / "t" / "_SUCCESS").exists()
    f.write_table(old.drop("year"), path, pieces=4, piece_key="k.1")
    assert tuples(f.read_table(spark, path)) == tuples(old.drop("year"))
    last = F.pmod(F.xxhash64("`k.1`"), F.lit(4)) == 3
    broken = old.withColumn("v", F.when(last, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        f.write_table(broken, path, ["year"], 4, "k.1")
    assert not (tmp_path / "t" / "_SUCCESS").exists() and spark.conf.get(FREED, None) is None


def test_the_setting_of_the_session_comes_back(spark):
    spark.conf.set(FREED, "false")
    try:
        with freed_shuffles(spark):
            assert spark.conf.get(FREED) == "true"
        assert spark.conf.get(FREED) == "false"
    finally:
        spark.conf.unset(FREED)


def write_tables(spark, folder):
    """Small tables with missing keys, keys without a partner, and order lines that come twice."""
    noon = dt.datetime(1997, 5, 1, 12)
    rows = {
        "region": [(0, "ASIA"), (1, "EUROPE")],
        "nation": [(0, "INDIA", 0), (1, "FRANCE", 1), (2, "JAPAN", 0)],
        "customer": [(k, f"Customer#{k}", k % 4 if k else None, 1.5, "FURNITURE") for k in range(6)],
        "part": [(k, f"large {x}", "Brand#1", "SMALL", 3, 900.1 + k) for k, x in enumerate(["ring", "bolt", "gear"])],
        "orders": [(k, k % 8 if k % 5 else None, "O", 1.0, noon + dt.timedelta(97 * k) if k % 6 else None, "1") for k in range(30)],
        "lineitem": [
            (None if n % 11 == 0 else n % 33, None if n % 7 == 0 else n % 4, n % 2, n % 5, float(n % 50), 1.25 * n, 0.0, 0.0, "A", "F", noon)
            for n in [*range(120), *range(100, 120)]
        ],
    }
    for name, of in rows.items():
        table = spark.createDataFrame(of, s.TABLE_SCHEMAS[name]).coalesce(1)
        table.write.parquet(f"{folder}/{name}.parquet")


def test_sales_export_in_pieces_equals_its_sql(spark, tmp_path, monkeypatch):
    write_tables(spark, tmp_path)
    tables = s.SalesTables(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in s.TABLE_SCHEMAS:
        if name != "events":
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    query = REGISTERED["sales_export"]
    assert tables.pieces() == 1
    assert differences(query.build(tables), con, query.sql) == ""
    monkeypatch.setattr(s, "PIECE_BYTES", 1)
    assert tables.pieces() == s.MOST_PIECES
    assert differences(query.build(tables), con, query.sql) == ""
