import datetime as dt

import pytest

from spokewise.sources import cells as c


def write(folder, text, name="in.csv"):
    (folder / name).write_text(text)
    return str(folder / name)


@pytest.mark.parametrize(
    "values, kind",
    [
        (["T", "FALSE", "true", "NA"], "boolean"),
        (["1", "-2", "NA", "+0"], "int"),
        (["1", "3000000000"], "bigint"),
        (["1", "99999999999999999999"], "double"),
        (["1", "2.5", ".5", "1e3", "-4.", "NaN", "Inf"], "double"),
        (["2011-01-07", "2011/1/8"], "date"),
        (["2011-01-07", "2011-02-30"], "string"),
        (["2011-01-07 10:11:12.5", "2011-01-07T10:11"], "timestamp_ntz"),
        (["2011-01-07T10:11:12Z", "2011-01-07 10:11:12+02:00"], "timestamp"),
        (["2011-01-07T10:11:12Z", "2011-01-07T10:11:12"], "string"),
        (["9:05", "23:59:59.25"], c.TIME_TYPE),
        (["24:00"], "string"),
        (["007", "8"], "string"),
        (["1", "T"], "string"),
        (["2011-01-07", "12"], "string"),
        ([" 1"], "string"),
        ([".", "-", "e5"], "string"),
        (["NA", "NA"], "boolean"),
        ([], "boolean"),
    ],
)
def test_kind_of_a_column(spark, tmp_path, values, kind):
    path = write(tmp_path, "k,v\n" + "".join(f"x,{v}\n" for v in values))
    types = c.guess_types(c.read_text(spark, path, ignoreLeadingWhiteSpace="false"))
    assert types["v"] == kind


def test_a_late_cell_decides_and_values_are_typed(spark, tmp_path):
    lines = [f"{k},{k / 4},T,2012-03-0{k % 9 + 1},7:0{k % 10}:30" for k in range(300)]
    df = c.read_guessed(spark, write(tmp_path, "a.b,x,l,d,t\n" + "\n".join(lines) + "\n"))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double", "boolean", "date", "interval day to second"]
    assert tuple(df.filter("`a.b` = 5").first()) == (5, 1.25, True, dt.date(2012, 3, 6), dt.timedelta(hours=7, minutes=5, seconds=30))
    late = c.read_guessed(spark, write(tmp_path, "a.b,x\n" + "\n".join([*(f"{k},1" for k in range(300)), "n/a,2"]) + "\n", "late.csv"))
    assert [f.dataType.simpleString() for f in late.schema] == ["string", "int"] and late.count() == 301


def test_one_scan_judges_all_columns(spark, tmp_path):
    text = c.read_text(spark, write(tmp_path, "a,b\n1,x\n"))
    agg = text.agg(*[c.F.bit_and(c._fits(c.F.col(n))) for n in text.columns])
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "partial_bit_and" in plan


def test_every_bad_cell_is_listed(spark, tmp_path):
    path = write(tmp_path, "k,n,x,d\n1,2,2.5,2012-01-02\n2,x,y,NA\n\n3,,1,2012-13-01\n4,5\n5,6,7,2012-01-01,9\n6,1.5,NA,2012-01-01\n")
    found = c.cell_problems(spark, path, "k string, n int, x double, d date", keep=["k"]).collect()
    assert {r.file.rsplit("/", 1)[1] for r in found} == {"in.csv"}
    assert sorted((r.row, r.k, r.column_name or "", r.expected, r.found) for r in found) == [
        (2, "2", "n", "int", "x"),
        (2, "2", "x", "double", "y"),
        (3, "3", "d", "date", "2012-13-01"),
        (4, "4", "", "4 columns", "4,5"),
        (5, "5", "", "4 columns", "5,6,7,2012-01-01,9"),
        (6, "6", "n", "int", "1.5"),
    ]
    assert c.cell_problems(spark, write(tmp_path, "k\n1\n", "fine.csv"), "k int").count() == 0
    assert c.cell_problems(spark, write(tmp_path, "k\n", "empty.csv"), "k int").count() == 0


def test_rows_are_counted_through_blocks_and_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    wanted = set()
    for name, size in (("a.csv", 900), ("b.csv", 40), ("c.csv", 1)):
        bad = lambda k: k % 7 == 0 or k == 1
        write(folder, "k,v\n" + "".join(f"{k},{'bad' if bad(k) else k}\n" for k in range(1, size + 1)), name)
        wanted |= {(name, k, str(k)) for k in range(1, size + 1) if bad(k)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = c.cell_problems(spark, str(folder), "k bigint, v int", keep=["k"]).collect()
        blocks = c.read_text(spark, str(folder)).select("_metadata.file_block_start", "_metadata.file_path").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks > 5
    assert {(r.file.rsplit("/", 1)[1], r.row, r.k) for r in found} == wanted and len(found) == len(wanted)


EDGES = [
    *["2147483647", "2147483648", "-2147483648", "-2147483649", "+2147483647", "9223372036854775807", "9223372036854775808"],
    *["-9223372036854775808", "-9223372036854775809", "+9223372036854775807", "1" * 18, "1" * 19, "9" * 20, "1" * 24, "1" * 400, "0", "-0", "00", "+"],
    *["1e400", "4.", ".5", ".", "NaN", "Inf", "-Inf", "inf", "T", "true", "TRUE", "t", "2011-01-07", "2011/1/8", "2011-02-30", "0000-01-01", "2011-1"],
    *["2011-01-07 10:11", "2011-01-07 25:11", "2011-02-30 10:11", "2011-01-07T10:11:12Z", "2011-01-07T10:11:12+99:00", "9:05", "24:00", "23:59:59.1234567"],
    *["12\n", "T\n", "1.5\n", "9:05\n", "12\u2028", "9223372036854775807\n", "-9223372036854775808\n", "a:b", "", " ", "words", "1 ", None],
]


def test_a_cell_fits_what_it_can_be_read_as(spark):
    """The bits of a cell are those of all kinds it can be turned into."""
    df = spark.createDataFrame([(k, v) for k, v in enumerate(EDGES)], "k int, v string")
    cell = c.F.col("v")
    each = [c.F.when(c.to_kind(cell, kind).isNotNull(), c._BIT[kind]).otherwise(0) for kind in c.KINDS]
    wanted = c.F.when(cell.isNotNull(), c.F.lit(0) + sum(each))
    rows = df.select("v", c._fits(cell).alias("found"), wanted.alias("wanted")).collect()
    assert [(r.v, r.found) for r in rows] == [(r.v, r.wanted) for r in rows]


def test_the_code_that_judges_does_not_grow_with_the_columns(spark, monkeypatch):
    """One copy of the rules for all columns: with one copy each, Java no longer compiles the generated method."""
    asked = []
    real = c._fits
    monkeypatch.setattr(c, "_fits", lambda cell: asked.append(cell) or real(cell))
    df = spark.createDataFrame([("1", "x", None, "9:05")] * 3, "a string, `b.c` string, d string, e string")
    assert c.guess_types(df) == {"a": "int", "b.c": "string", "d": "boolean", "e": c.TIME_TYPE}
    assert len(asked) == 1
