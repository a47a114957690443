from pyspark.sql import functions as F

from spokewise.functions import formats as fm
from spokewise.functions import numbers as nb


def value(spark, column):
    return spark.range(1).select(column.alias("y")).first()[0]


def texts(spark, amounts, **options):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "i int, a double")
    return [r.a_text for r in fm.with_dollar_text(df, "a", **options).orderBy("i").collect()]


def test_conversion(spark):
    assert value(spark, nb.to_number(F.lit("x"))) is None
    assert value(spark, nb.to_number(F.lit("12.5"))) == 12.5


def test_math(spark):
    assert value(spark, nb.power(F.lit(9.0), 0.5)) == 3
    assert value(spark, nb.natural_log(F.lit(1.0))) == 0
    assert value(spark, nb.natural_log(F.lit(0.0))) is None


def test_first_case_and_recode(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    x = F.col("x")
    label = nb.first_case([(x > 4, F.lit("big")), (x > 0, F.lit("small"))], F.lit("none"))
    assert [r[0] for r in df.select(label).collect()] == ["small", "big", "none"]
    names = spark.createDataFrame([("old",), ("kept",), (None,)], "m string")
    assert [r[0] for r in names.select(nb.recode(F.col("m"), {"old": "new"})).collect()] == [
        "new",
        "kept",
        None,
    ]


def test_dollar_text_depends_on_the_whole_column(spark):
    assert texts(spark, [1.5, 1234.0, None]) == ["$1.50", "$1,234.00", None]
    assert texts(spark, [1.0, 1234.0]) == ["$1", "$1,234"]
    assert texts(spark, [1.5, 123456.25]) == ["$2", "$123,456"]
    assert texts(spark, [24044.9], largest_with_cents=10) == ["$24,045"]
    assert texts(spark, [-1234.5]) == ["-$1,234.50"]
    assert texts(spark, [2_500_000.0], scale=1e-6, suffix="M") == ["$2.50M"]
    assert texts(spark, [1e6]) == ["$1,000,000"]


def test_number_and_percent_text(spark):
    assert value(spark, fm.number_text(F.lit(1e6))) == "1,000,000"
    assert value(spark, fm.number_text(F.lit(1e6), scale=1e-6, prefix="$", suffix="M")) == "$1M"
    assert value(spark, fm.number_text(F.lit(1e6), thousands=False)) == "1000000"
    assert value(spark, fm.percent_text(F.lit(0.15))) == "15.0%"
    assert value(spark, fm.percent_text(F.lit(0.15), accuracy=1)) == "15%"
    assert value(spark, fm.percent_text(F.lit(-0.12345), accuracy=0.01)) == "-12.35%"
    assert value(spark, fm.percent_text(F.lit(None).cast("double"))) is None


def test_what_rounds_to_zero_has_no_sign(spark):
    from spokewise.functions.formats import dollar_text

    df = spark.createDataFrame([(-0.3,), (-0.6,), (0.0,), (-12.0,)], "v double")
    assert [r[0] for r in df.select(dollar_text(F.col("v"))).collect()] == ["$0", "-$1", "$0", "-$12"]


def test_percent_text_and_its_sql_agree_below_zero(spark):
    import duckdb

    from spokewise.registered.series import _PERCENT

    shares = [-0.5, -0.0006, -0.0004, -0.0, 0.0, 0.0004, 0.0006, 12.5]
    df = spark.createDataFrame([(v,) for v in shares], "v double")
    found = [r[0] for r in df.select(fm.percent_text(F.col("v"))).collect()]
    wanted = [duckdb.sql(f"SELECT {_PERCENT.format(f'({v!r}::DOUBLE)')}").fetchall()[0][0] for v in shares]
    assert found == wanted
    assert found[1:5] == ["-0.1%", "0.0%", "0.0%", "0.0%"]


def test_detect_in_any_case(spark):
    from spokewise.functions.text import detect

    df = spark.createDataFrame([("Supersix Evo",), ("SUPERSIX",), ("caad",)], "m string")
    found = df.select(detect(F.col("m"), "Supersix", ignore_case=True)).collect()
    assert [r[0] for r in found] == [True, True, False]
