"""Date and time expressions. Run sessions in UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECOND = 1
MINUTE = 60
DAY = 86_400

# Order of the parts of a date.
YMD, MDY, DMY = "ymd", "mdy", "dmy"
# Two-digit years above this one belong to the 1900s.
LAST_SHORT_YEAR = 68
# English month names, read in full or by their first three letters in any case.
MONTHS = (
    "january february march april may june july august september october november december"
).split()

_SEPARATORS = r"(?<=\d)T(?=\d)|[^\p{L}\p{N}]+"


def _small_number(text: Column) -> Column:
    """A number of one or two digits as text, else NULL."""
    return F.when((F.length(text) <= 2) & text.try_cast("int").isNotNull(), text)


def _year(text: Column) -> Column:
    number = text.try_cast("int")
    century = F.when(number > LAST_SHORT_YEAR, "19").otherwise("20")
    return F.when(number.isNull(), None).when(F.length(text) == 4, text).when(F.length(text) == 2, F.concat(century, text))


def _month(text: Column) -> Column:
    names = F.create_map(*[F.lit(v) for k, m in enumerate(MONTHS) for n in dict.fromkeys([m, m[:3]]) for v in (n, str(k + 1))])
    return F.coalesce(_small_number(text), F.try_element_at(names, F.lower(text)))


def _parse(text: Column, parts: str, clock: bool) -> Column:
    """Read a date, or with ``clock`` a date and time of day, in one pass over the text.

    The text is split into words once, and the words are the parts; a date of year,
    month and day may also be one word of eight digits. Casts that give NULL instead of
    an error check the ranges.
    """
    size = len(parts) + (3 if clock else 0)

    def joined(mark: str, *texts: Column) -> Column:
        # NULL if a part is: a shorter text would be the first of a month or year.
        return F.concat(*[t for text in texts for t in (F.lit(mark), text)][1:])

    def read(words: Column) -> Column:
        at = {part: F.get(words, F.lit(k)) for k, part in enumerate(parts)}
        found = F.when(F.size(words) == size, joined("-", _year(at["y"]), _month(at["m"]), _small_number(at["d"])))
        if parts == YMD:
            first = F.get(words, F.lit(0))
            digits = joined("-", *[F.substr(first, F.lit(a), F.lit(n)) for a, n in ((1, 4), (5, 2), (7, 2))])
            found = found.when((F.size(words) == size - 2) & (F.length(first) == 8) & first.try_cast("int").isNotNull(), digits)
        if not clock:
            return found
        time = joined(":", *[_small_number(F.get(words, F.size(words) - k)) for k in (3, 2, 1)])
        return F.concat(found, F.lit(" "), time)

    # Through an array, so that the words are cut once and then shared.
    whole = F.transform(F.array(F.split(F.trim(text), _SEPARATORS)), read)[0]
    return whole.try_cast("timestamp" if clock else "date")


def parse_ymd(text: Column) -> Column:
    """Date from year-month-day text; NULL where it is none."""
    return _parse(text, YMD, False)


def parse_mdy(text: Column) -> Column:
    """Date from month-day-year text, the month as number or English name."""
    return _parse(text, MDY, False)


def parse_dmy(text: Column) -> Column:
    return _parse(text, DMY, False)


def parse_ymd_hms(text: Column) -> Column:
    return _parse(text, YMD, True)


def parse_mdy_hms(text: Column) -> Column:
    return _parse(text, MDY, True)


def as_date(moment: Column) -> Column:
    """The date part of a timestamp."""
    return moment.cast("date")


def month_label(moment: Column, short: bool = True) -> Column:
    """English month name; sort by ``F.month``."""
    return F.date_format(moment, "MMM" if short else "MMMM")


def weekday_label(moment: Column, short: bool = True) -> Column:
    return F.date_format(moment, "EEE" if short else "EEEE")


def floor_date(moment: Column, unit: str) -> Column:
    """First day of the week, month, quarter or year, as a date."""
    return F.trunc(moment, unit)


def date_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def add_days(moment: Column, days: int) -> Column:
    """Move by calendar days; the wall clock stays."""
    return moment + F.make_dt_interval(F.lit(days))


def add_seconds(moment: Column, seconds: float) -> Column:
    """Move by an exact length of time, also across a clock change."""
    micros = F.unix_micros(moment.cast("timestamp")) + F.lit(round(seconds * 1_000_000))
    return F.timestamp_micros(micros)


def length_between(start: Column, end: Column, unit: int = DAY) -> Column:
    """Exact time from ``start`` to ``end`` in units of so many seconds, signed."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(unit * 1_000_000)
