import datetime as dt

import pytest
from pyspark.sql import functions as F

from spokewise.functions import dates as d

DAY = dt.date


def value(spark, column):
    return spark.range(1).select(column.alias("y")).first()[0]


@pytest.mark.parametrize(
    "parse, text, wanted",
    [
        (d.parse_ymd, "2025-03-15", DAY(2025, 3, 15)),
        (d.parse_ymd, "2011-1-1", DAY(2011, 1, 1)),
        (d.parse_ymd, "20110101", DAY(2011, 1, 1)),
        (d.parse_ymd, "2011/02/30", None),
        (d.parse_ymd, "no date", None),
        (d.parse_mdy, "06/01/25", DAY(2025, 6, 1)),
        (d.parse_mdy, "06/01/70", DAY(1970, 6, 1)),
        (d.parse_mdy, "06/01/68", DAY(2068, 6, 1)),
        (d.parse_mdy, "06/01/69", DAY(1969, 6, 1)),
        (d.parse_mdy, "January 1 1985", DAY(1985, 1, 1)),
        (d.parse_mdy, "Jan 1, 1985", DAY(1985, 1, 1)),
        (d.parse_dmy, "24.12.2025", DAY(2025, 12, 24)),
        (d.parse_ymd, "99-1-2", DAY(1999, 1, 2)),
        (d.parse_ymd, "2024 2 29", DAY(2024, 2, 29)),
        (d.parse_ymd, "2023 2 29", None),
        (d.parse_ymd, "20230229", None),
        (d.parse_ymd, "2023-2", None),
        (d.parse_ymd, "2023", None),
        (d.parse_ymd, "", None),
        (d.parse_ymd, None, None),
        (d.parse_ymd, "2023-13-01", None),
        (d.parse_ymd, "2023-0-1", None),
        (d.parse_ymd, "2023-01-01-01", None),
        (d.parse_ymd, "2023-1-1T", None),
        (d.parse_ymd, "2023-1-5T6", None),
        (d.parse_ymd, "123-1-1", None),
        (d.parse_ymd, "2023-001-1", None),
        (d.parse_ymd, "x2023-1-1", None),
        (d.parse_mdy, "MARCH 5 99", DAY(1999, 3, 5)),
        (d.parse_mdy, "Sept 5 1999", None),
        (d.parse_mdy, "13/1/2020", None),
        (d.parse_mdy, "20200101", None),
        (d.parse_dmy, "1 may 2020", DAY(2020, 5, 1)),
        (d.parse_dmy, "29 Feb 2021", None),
        (d.parse_dmy, "5-dEc-07", DAY(2007, 12, 5)),
        (d.parse_ymd_hms, "20250601 6:3:5", dt.datetime(2025, 6, 1, 6, 3, 5)),
        (d.parse_ymd_hms, "2025-06-01 24:00:00", None),
        (d.parse_ymd_hms, "2025-06-01 06:30", None),
        (d.parse_ymd_hms, "2025-06-01 06:30:61", None),
        (d.parse_ymd_hms, "2025-06-01", None),
        (d.parse_mdy_hms, "Jan 5, 2020 1:02:03", dt.datetime(2020, 1, 5, 1, 2, 3)),
        (d.parse_ymd_hms, "2025-06-01 06:30:30", dt.datetime(2025, 6, 1, 6, 30, 30)),
        (d.parse_ymd_hms, "2025-06-01T06:30:30", dt.datetime(2025, 6, 1, 6, 30, 30)),
        (d.parse_mdy_hms, "06/01/25 06:30:30", dt.datetime(2025, 6, 1, 6, 30, 30)),
        (d.parse_mdy_hms, "06/01/70 06:30:30", dt.datetime(1970, 6, 1, 6, 30, 30)),
    ],
)
def test_parsing(spark, parse, text, wanted):
    found = parse(F.lit(text))
    if isinstance(wanted, dt.datetime):
        found, wanted = F.date_format(found, "yyyy-MM-dd HH:mm:ss"), str(wanted)
    assert value(spark, found) == wanted


def test_parts_and_labels(spark):
    day = F.lit("2025-03-15").cast("date")
    assert value(spark, d.month_label(day)) == "Mar"
    assert value(spark, F.month(day)) == 3
    assert value(spark, d.weekday_label(day)) == "Sat"
    july = F.lit("2025-07-04 10:00:00").cast("timestamp")
    assert value(spark, F.year(july)) == 2025
    assert (value(spark, d.month_label(july)), value(spark, d.month_label(july, False))) == ("Jul", "July")
    assert value(spark, d.date_text(july)) == "2025-07-04"


def test_floor(spark):
    day = F.lit("2025-08-15").cast("timestamp_ntz")
    assert value(spark, d.floor_date(day, "month")) == DAY(2025, 8, 1)
    assert value(spark, d.floor_date(day, "quarter")) == DAY(2025, 7, 1)


def test_interval_length(spark):
    start = F.lit("2025-06-23").cast("timestamp")
    end = d.add_seconds(start, 12 * d.DAY)
    assert value(spark, d.length_between(start, end)) == 12
    assert value(spark, d.length_between(start, end, d.MINUTE)) == 17280
    assert value(spark, d.length_between(end, d.add_seconds(start, 0.5 * d.DAY))) == -11.5


def test_a_period_keeps_the_clock_and_a_duration_keeps_the_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        before = F.lit("2025-03-08 12:00:00").cast("timestamp")
        shown = [
            value(spark, F.date_format(moved, "MM-dd HH:mm"))
            for moved in (d.add_days(before, 1), d.add_seconds(before, d.DAY))
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert shown == ["03-09 12:00", "03-09 13:00"]
