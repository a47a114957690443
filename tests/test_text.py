import pytest
from pyspark.sql import functions as F

from spokewise.functions import text as tx


def values(spark, change, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.select(change(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]



def test_detect_finds_inside_and_keeps_case(spark):
    found = values(spark, lambda x: tx.detect(x, "Supersix"), "Supersix Evo Black Inc.", "a supersix", None)
    assert found == [True, False, None]
    assert values(spark, lambda x: tx.detect(x, "pear"), "  Two ripe pear trees") == [True]
    assert values(spark, lambda x: tx.flag(x, "black"), "Evo BLACK", "Evo", None) == [1, 0, None]


def test_case(spark):
    shop = "ithaca Mountain climbers"
    assert values(spark, lambda x: tx.title_case(x), shop, "hi-mod", "dog's 29er", "A  b", None) == [
        "Ithaca Mountain Climbers",
        "Hi-Mod",
        "Dog's 29er",
        "A  B",
        None,
    ]
    assert values(spark, lambda x: tx.sentence_case(x), shop, "", None) == ["Ithaca mountain climbers", "", None]


def test_concatenation_and_missing_values(spark):
    assert values(spark, lambda x: tx.join_text(x, F.lit("World"), sep=" "), "Hello", None) == ["Hello World", None]
    assert values(spark, lambda x: tx.glue("Lift {x} carries {s} kg", s=F.lit(95)), "North", None) == [
        "Lift North carries 95 kg",
        "Lift NA carries 95 kg",
    ]


def test_glue_shows_whole_numbers_without_fraction(spark):
    df = spark.createDataFrame([(1, 2)], "order_id bigint, order_line bigint")
    assert df.select(tx.glue("{order_id}.{order_line}")).first()[0] == "1.2"


def test_split(spark):
    assert values(spark, lambda x: tx.split_text(x, ","), "tin,zinc,lead") == [["tin", "zinc", "lead"]]
    inputs = ("Road - Elite Road - Carbon", "Road - Elite Road", None)
    assert values(spark, lambda x: tx.split_fixed(x, " - ", 3)[2], *inputs) == ["Carbon", "", None]


def test_trim_takes_all_white_space(spark):
    assert values(spark, lambda x: tx.trim(x), " Padded on both sides. ", "\t a\nb \n", None) == [
        "Padded on both sides.",
        "a\nb",
        None,
    ]


def test_replace(spark):
    models = ("CAD12", "CAD", "CAD8", None)
    assert values(spark, lambda x: tx.replace_first(x, "[0-9]"), *models) == ["CAD2", "CAD", "CAD", None]
    assert values(spark, lambda x: tx.replace_all(x, "[0-9]"), *models) == ["CAD", "CAD", "CAD", None]
    assert values(spark, lambda x: tx.remove_all(x, r"\$|,"), "$1,234,567") == ["1234567"]
    assert values(spark, lambda x: tx.replace_literal(x, "_", " "), "a_b_c") == ["a b c"]
    text = "one the two the"
    assert values(spark, lambda x: tx.replace_first(x, "the", "a"), text) == ["one a two the"]
    assert values(spark, lambda x: tx.replace_first(x, "b|c", "X"), "line\nabc") == ["line\naXc"]


def test_replace_first_takes_the_pattern_from_a_column(spark):
    df = spark.createDataFrame(
        [("Trigger Carbon 1", "Trigger"), ("a.b", "."), ("none", None)], "m string, p string"
    )
    found = [r[0] for r in df.select(tx.replace_first(F.col("m"), F.col("p"))).collect()]
    assert found == [" Carbon 1", ".b", None]


def test_separate_pads_right_and_drops_extra(spark):
    df = spark.createDataFrame(
        [(1, "a - b - c - d", 9), (2, "a - b", 8), (3, None, 7)], "k int, d string, z int"
    )
    split = tx.separate(df, "d", ["x", "y", "w"], " - ")
    assert split.columns == ["k", "x", "y", "w", "z"]
    assert [tuple(r) for r in split.orderBy("k").collect()] == [
        (1, "a", "b", "c", 9),
        (2, "a", "b", None, 8),
        (3, None, None, None, 7),
    ]
    assert tx.separate(df, "d", ["x"], " - ", remove=False).columns == ["k", "d", "x", "z"]


def test_separate_a_date(spark):
    df = spark.createDataFrame([("2025-07-24",)], "full_date string")
    assert tuple(tx.separate(df, "full_date", ["year", "month", "day"]).first()) == ("2025", "07", "24")


def test_unite(spark):
    df = spark.createDataFrame([("John", "Doe"), ("Jane", None)], "first string, last string")
    united = tx.unite(df, "full_name", ["first", "last"], sep=" ")
    assert united.columns == ["full_name"]
    assert sorted(r[0] for r in united.collect()) == ["Jane NA", "John Doe"]
    assert tx.unite(df, "n", ["first", "last"], remove=False).columns == ["n", "first", "last"]


def test_numbered_names():
    assert tx.numbered_names("model_", 3) == ["model_1", "model_2", "model_3"]


@pytest.mark.parametrize("metacharacter", ["(", "["])
def test_a_broken_pattern_is_an_error(spark, metacharacter):
    with pytest.raises(Exception):
        values(spark, lambda x: tx.replace_first(x, metacharacter), "abc")
