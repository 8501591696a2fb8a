"""Rewriting of dates, weekday names and time words inside article text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.dates import CALENDAR, DAY_SUFFIX, NEPALI_MONTHS, BSCalendar, day_label, month_number, to_number
from newsloom.functions.patterns import BLANK, DIGIT, WORD, let, rewrite_matches

# Weekday names and time words with their English forms.
WEEKDAYS = {
    "आइतबार": "Sunday",
    "सोमबार": "Monday",
    "मंगलबार": "Tuesday",
    "बुधबार": "Wednesday",
    "बिहीबार": "Thursday",
    "शुक्रबार": "Friday",
    "शनिबार": "Saturday",
}
TIME_WORDS = {"गत": "last"}

# Year - month - day with its suffix, month - day, day - month.
YEAR_MONTH_DAY = f"({DIGIT}{{4}}){BLANK}*({WORD}+){BLANK}*({DIGIT}{{1,2}}){BLANK}*गते?"
# A word is tried from its first letter, or from where the last match ended, so a long run is read once.
MONTH_DAY = f"(?:(?<!{WORD})|\\G)({WORD}+){BLANK}*({DIGIT}{{1,2}})"
DAY_MONTH = f"({DIGIT}{{1,2}}){BLANK}*({WORD}+)"


def names_a_month(col: Column) -> Column:
    """Plain substring tests; a pattern of alternatives would try each of them at every character."""
    found = F.lit(False)
    for name in NEPALI_MONTHS:
        found = found | col.contains(name)
    return found


def rename_words(col: Column, words: dict[str, str]) -> Column:
    for old, new in words.items():
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def rename_weekdays(col: Column) -> Column:
    return rename_words(col, WEEKDAYS)


def rename_time_words(col: Column, words: dict[str, str] | None = None, word_boundary: bool = False) -> Column:
    """Plain substring replacement; ``word_boundary=True`` leaves longer words alone."""
    words = TIME_WORDS if words is None else words
    if not word_boundary:
        return rename_words(col, words)
    for old, new in words.items():
        col = F.regexp_replace(col, rf"(?<!{WORD})\Q{old}\E(?!{WORD})", new)
    return col


def _rewrite(col: Column, pattern: str, year, month: int, day: int, calendar: BSCalendar) -> Column:
    whole = f"^{pattern}\\z"
    # Only this form needs the day suffix; without it in the text there is nothing to try.
    needs = F.lit(True) if pattern != YEAR_MONTH_DAY else col.contains(DAY_SUFFIX[:-1])

    def label(match: Column) -> Column:
        number = to_number(F.regexp_extract(match, whole, year)) if isinstance(year, int) else year
        return day_label(
            calendar.to_date(
                number,
                month_number(F.regexp_extract(match, whole, month)),
                to_number(F.regexp_extract(match, whole, day)),
            )
        )

    # A match changes only when it holds a month name, so a text without one is left out.
    return let(col, lambda text: F.when(names_a_month(text) & needs, rewrite_matches(text, pattern, label)).otherwise(text))


def rewrite_year_month_day(col: Column, calendar: BSCalendar = CALENDAR) -> Column:
    return _rewrite(col, YEAR_MONTH_DAY, 1, 2, 3, calendar)


def rewrite_month_day(col: Column, reference_year: int, calendar: BSCalendar = CALENDAR) -> Column:
    return _rewrite(col, MONTH_DAY, F.lit(reference_year), 1, 2, calendar)


def rewrite_day_month(col: Column, reference_year: int, calendar: BSCalendar = CALENDAR) -> Column:
    return _rewrite(col, DAY_MONTH, F.lit(reference_year), 2, 1, calendar)


def rewrite_dates(col: Column, reference_year: int, calendar: BSCalendar = CALENDAR) -> Column:
    """Weekdays, then the three date forms, each over the output of the one before.

    ``reference_year`` is the BS year of a mention without a year.
    """
    col = rename_weekdays(col)
    col = rewrite_year_month_day(col, calendar)
    col = rewrite_month_day(col, reference_year, calendar)
    return rewrite_day_month(col, reference_year, calendar)


def rewrite_text(
    col: Column, reference_year: int, calendar: BSCalendar = CALENDAR, word_boundary: bool = False
) -> Column:
    return rename_time_words(rewrite_dates(col, reference_year, calendar), word_boundary=word_boundary)
