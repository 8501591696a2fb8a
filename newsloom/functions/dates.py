"""Bikram Sambat (BS) and Gregorian date functions."""

from __future__ import annotations

import datetime
import unicodedata
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.patterns import BLANK, DIGIT, WORD, let, strip

# Month names by month number, in both scripts.
NEPALI_MONTHS = {
    "बैशाख": 1,
    "जेठ": 2,
    "असार": 3,
    "साउन": 4,
    "भदौ": 5,
    "आश्विन": 6,
    "कार्तिक": 7,
    "मंसिर": 8,
    "पुष": 9,
    "माघ": 10,
    "फागुन": 11,
    "चैत्र": 12,
    "Baisakh": 1,
    "Jestha": 2,
    "Ashar": 3,
    "Shrawan": 4,
    "Bhadra": 5,
    "Ashwin": 6,
    "Kartik": 7,
    "Mangsir": 8,
    "Poush": 9,
    "Magh": 10,
    "Falgun": 11,
    "Chaitra": 12,
}
# The day suffix and the digits.
DAY_SUFFIX = "गते"
DEVANAGARI_DIGITS = "०१२३४५६७८९"
ASCII_DIGITS = "0123456789"

# Days in each month of a BS year.
BS_FIRST_DAY = datetime.date(2013, 4, 14)  # 1 Baisakh of the first year below
BS_MONTH_LENGTHS = {
    2070: (31, 31, 31, 32, 31, 31, 29, 30, 30, 29, 30, 30),
    2071: (31, 31, 32, 31, 31, 31, 30, 29, 30, 29, 30, 30),
    2072: (31, 32, 31, 32, 31, 30, 30, 29, 30, 29, 30, 30),
    2073: (31, 32, 31, 32, 31, 30, 30, 30, 29, 29, 30, 31),
    2074: (31, 31, 31, 32, 31, 31, 30, 29, 30, 29, 30, 30),
    2075: (31, 31, 32, 31, 31, 31, 30, 29, 30, 29, 30, 30),
    2076: (31, 32, 31, 32, 31, 30, 30, 30, 29, 29, 30, 30),
    2077: (31, 32, 31, 32, 31, 30, 30, 30, 29, 30, 29, 31),
    2078: (31, 31, 31, 32, 31, 31, 30, 29, 30, 29, 30, 30),
    2079: (31, 31, 32, 31, 31, 31, 30, 29, 30, 29, 30, 30),
    2080: (31, 32, 31, 32, 31, 30, 30, 30, 29, 29, 30, 30),
    2081: (31, 32, 31, 32, 31, 30, 30, 30, 29, 30, 29, 31),
    2082: (31, 31, 32, 31, 31, 31, 30, 29, 30, 29, 30, 30),
    2083: (31, 31, 32, 31, 31, 30, 30, 30, 29, 30, 30, 30),
    2084: (31, 31, 32, 31, 31, 30, 30, 30, 29, 30, 30, 30),
    2085: (31, 32, 31, 32, 30, 31, 30, 30, 29, 30, 30, 30),
}

# Every decimal digit of the basic plane, so that a number in any script reads as a number.
_ALL_DIGITS = "".join(c for c in map(chr, range(0x10000)) if c not in ASCII_DIGITS and unicodedata.decimal(c, -1) >= 0)
_ALL_VALUES = "".join(str(unicodedata.decimal(c)) for c in _ALL_DIGITS)


@dataclass(frozen=True)
class BSCalendar:
    """Consecutive BS years. Give other ``lengths``, for instance by `from_rows`, to cover other years."""

    lengths: dict[int, tuple[int, ...]] = field(default_factory=lambda: dict(BS_MONTH_LENGTHS))
    first_day: datetime.date = BS_FIRST_DAY

    @classmethod
    def from_rows(cls, rows: Iterable[Sequence[int]], known_year: int = 2070, known_day: datetime.date = BS_FIRST_DAY) -> BSCalendar:
        """A calendar from rows of a year and its twelve month lengths, hung up at the first day of a known year."""
        lengths = {int(row[0]): tuple(int(days) for days in row[1:]) for row in rows}
        years = sorted(lengths)
        if not years or years != list(range(years[0], years[-1] + 1)) or any(len(m) != 12 for m in lengths.values()):
            raise ValueError("a calendar needs consecutive years of twelve months")
        if not years[0] <= known_year <= years[-1] + 1:
            raise ValueError("the known year must be one of the calendar, or the next")
        before = sum(sum(lengths[y]) for y in years if y < known_year)
        return cls(lengths, known_day - datetime.timedelta(days=before))

    @property
    def first_year(self) -> int:
        return min(self.lengths)

    def month_starts(self) -> list[datetime.date]:
        """First day of each month in order, and the first day after the last month."""
        starts = [self.first_day]
        for year in sorted(self.lengths):
            for days in self.lengths[year]:
                starts.append(starts[-1] + datetime.timedelta(days=days))
        return starts

    def to_date(self, year: Column, month: Column, day: Column) -> Column:
        """Gregorian date of a BS date; null outside the table or for a day the month does not have."""
        starts = F.array(*[F.lit(d) for d in self.month_starts()])
        months = 12 * len(self.lengths)

        def lookup(ymd: Column) -> Column:
            index = (ymd["year"] - F.lit(self.first_year)) * 12 + ymd["month"]
            inside = ymd["month"].between(1, 12) & index.between(1, months)
            start = F.when(inside, F.try_element_at(starts, index))
            end = F.when(inside, F.try_element_at(starts, index + 1))
            fits = (ymd["day"] >= 1) & (ymd["day"] <= F.datediff(end, start))
            return F.when(fits, F.date_add(start, ymd["day"] - 1))

        return let(F.struct(year.alias("year"), month.alias("month"), day.alias("day")), lookup)


CALENDAR = BSCalendar()


def dev_to_ascii(col: Column) -> Column:
    return F.translate(col, DEVANAGARI_DIGITS, ASCII_DIGITS)


def to_number(col: Column) -> Column:
    """Integer of decimal digits of any script; the two common scripts take the short way."""
    common = dev_to_ascii(col)
    return F.when(common.rlike("^[0-9]*+$"), common).otherwise(F.translate(col, _ALL_DIGITS, _ALL_VALUES)).try_cast("int")


def month_number(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in NEPALI_MONTHS.items() for x in pair])
    return F.try_element_at(table, name)


# A clock time, and year - month word - day.
CLOCK = f"{DIGIT}{{1,2}}:{DIGIT}{{2}}"
BS_DATE = f"({DIGIT}{{4}}){BLANK}*({WORD}+){BLANK}*({DIGIT}{{1,2}})"


def bs_date_text(col: Column) -> Column:
    """The part of a date line that holds the date: before the day suffix and without clock times."""
    head = strip(F.split_part(col, F.lit(DAY_SUFFIX), F.lit(1)))
    return strip(F.regexp_replace(head, CLOCK, ""))


def bs_parts(col: Column) -> Column:
    """``struct(year, month, day)`` of the first BS-looking date, or null; an unknown month name is a null month."""
    return let(
        bs_date_text(col),
        lambda text: F.when(
            text.rlike(BS_DATE),
            F.struct(
                to_number(F.regexp_extract(text, BS_DATE, 1)).alias("year"),
                month_number(F.regexp_extract(text, BS_DATE, 2)).alias("month"),
                to_number(F.regexp_extract(text, BS_DATE, 3)).alias("day"),
            ),
        ),
    )


def parse_nepali_date(col: Column, calendar: BSCalendar = CALENDAR) -> Column:
    """``struct(bs, greg, day_name)``; the whole struct is null when the text is no BS date."""

    def convert(bs: Column) -> Column:
        greg = calendar.to_date(bs["year"], bs["month"], bs["day"])
        return let(
            F.struct(bs.alias("bs"), greg.alias("greg"), F.date_format(greg, "EEEE").alias("day_name")),
            lambda row: F.when(row["greg"].isNotNull(), row),
        )

    return let(bs_parts(col), convert)


# The accepted forms of day, month and English month name.
_DAY = r"(3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9])"
_MONTH = r"(1[0-2]|0[1-9]|[1-9])"
_YEAR = r"(\d{4})"
ENGLISH_MONTHS = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]
_NAME = "(" + "|".join(ENGLISH_MONTHS) + ")"


def parse_gregorian_date(col: Column) -> Column:
    """DATE from ``Y-m-d``, ``d-m-Y``, ``d/m/Y``, ``Y/m/d``, ``Month d, Y`` or ``d Month Y``; else null.

    The four shapes exclude each other, so their order does not matter.
    """
    by_name = F.create_map(*[F.lit(x) for i, n in enumerate(ENGLISH_MONTHS, 1) for x in (n.lower(), f"{i:02d}")])

    def shape(pattern: str, year: int, month: int, day: int, named: bool = False) -> Column:
        part = lambda group: F.regexp_extract(col, pattern, group)
        number = F.try_element_at(by_name, F.lower(part(month))) if named else F.lpad(part(month), 2, "0")
        iso = F.concat_ws("-", part(year), number, F.lpad(F.trim(part(day)), 2, "0"))
        return F.when(col.rlike(pattern) & (part(year) != "0000"), iso.try_cast("date"))

    return F.coalesce(
        shape(rf"^{_YEAR}([-/]){_MONTH}\2{_DAY}\z", 1, 3, 4),
        shape(rf"^{_DAY}([-/]){_MONTH}\2{_YEAR}\z", 4, 3, 1),
        shape(rf"(?i)^{_NAME}{BLANK}+{_DAY},{BLANK}+{_YEAR}\z", 3, 1, 2, named=True),
        shape(rf"(?i)^{_DAY}{BLANK}+{_NAME}{BLANK}+{_YEAR}\z", 3, 2, 1, named=True),
    )


def gregorian_date(col: Column, calendar: BSCalendar = CALENDAR) -> Column:
    """DATE of a published-date line: BS first, Gregorian as fallback."""
    bs = let(bs_parts(col), lambda p: calendar.to_date(p["year"], p["month"], p["day"]))
    return F.coalesce(bs, parse_gregorian_date(col))


def day_label(date: Column) -> Column:
    """``YYYY-MM-DD (Weekday)``."""
    return F.date_format(date, "yyyy-MM-dd (EEEE)")


def published_label(col: Column, calendar: BSCalendar = CALENDAR) -> Column:
    return F.coalesce(day_label(gregorian_date(col, calendar)), F.lit(""))


def label_to_date(col: Column) -> Column:
    """DATE from the text before the first blank; null when that is no ISO date."""
    head = F.split_part(col, F.lit(" "), F.lit(1))
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}\z"), head.try_cast("date"))
