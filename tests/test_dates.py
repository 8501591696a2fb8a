import datetime

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates

from .conftest import rows


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x")).alias("v")).collect()]


def test_calendar_years_follow_each_other():
    starts = dates.CALENDAR.month_starts()
    first_days = {2077: "2020-04-13", 2078: "2021-04-14", 2079: "2022-04-14", 2080: "2023-04-14", 2081: "2024-04-13", 2082: "2025-04-14"}
    for year, first in first_days.items():
        assert starts[(year - dates.CALENDAR.first_year) * 12] == datetime.date.fromisoformat(first)
    assert starts[(2083 - dates.CALENDAR.first_year) * 12] == datetime.date(2026, 4, 14)
    assert all(sum(lengths) in (365, 366) and len(lengths) == 12 for lengths in dates.BS_MONTH_LENGTHS.values())


def test_calendar_agrees_with_a_day_count(spark):
    cal = dates.CALENDAR
    expected, day = {}, cal.first_day
    for year, lengths in cal.lengths.items():
        for month, days in enumerate(lengths, 1):
            for d in range(1, days + 1):
                expected[year, month, d] = day
                day += datetime.timedelta(days=1)
    keys = [(y, m, d) for y in range(2068, 2085) for m in range(0, 14) for d in range(0, 34)]
    df = spark.createDataFrame(keys, "y int, m int, d int")
    got = df.select("y", "m", "d", cal.to_date(F.col("y"), F.col("m"), F.col("d")).alias("g")).collect()
    assert {(r.y, r.m, r.d): r.g for r in got} == {k: expected.get(k) for k in keys}


@pytest.mark.parametrize(
    "line, label",
    [
        ("२०८२ साउन १२ गते १२:३०", "2025-07-28 (Monday)"),
        ("२०८२ साउन १२", "2025-07-28 (Monday)"),
        (" 2082Shrawan 12 गते", "2025-07-28 (Monday)"),
        ("प्रकाशित: १२:३० २०८१ बैशाख १", "2024-04-13 (Saturday)"),
        ("२०८२साउन१२", ""),  # the word takes the first digit of the day
        ("२०८२ साउन ३२", ""),
        ("२०९९ साउन १", ""),
        ("2082 shrawan 12", ""),
        ("2024-06-01", "2024-06-01 (Saturday)"),
        ("1-6-2024", "2024-06-01 (Saturday)"),
        ("01/06/2024", "2024-06-01 (Saturday)"),
        ("2024/6/1", "2024-06-01 (Saturday)"),
        ("June 1, 2024", "2024-06-01 (Saturday)"),
        ("1 june  2024", "2024-06-01 (Saturday)"),
        ("31/02/2024", ""),
        ("2024-06/01", ""),
        ("2024-13-01", ""),
        ("0000-01-01", ""),
        ("2024-06-01 ", ""),
        ("", ""),
    ],
)
def test_published_label(spark, line, label):
    assert values(spark, [line], dates.published_label) == [label]


def test_parse_nepali_date_parts(spark):
    df = spark.createDataFrame([("२०८२ साउन १२ गते",), ("junk",)], "x string")
    got = df.select(dates.parse_nepali_date(F.col("x")).alias("p")).select("p.bs.*", "p.greg", "p.day_name")
    assert rows(got) == rows(spark.createDataFrame([(2082, 4, 12, datetime.date(2025, 7, 28), "Monday"), (None,) * 5], "a int, b int, c int, d date, e string"))


def test_digits_and_heads(spark):
    assert values(spark, ["a०१२३४५६७८९b5"], dates.dev_to_ascii) == ["a0123456789b5"]
    assert values(spark, ["٢٠٨٢", "२०८२", "2082", "x", ""], dates.to_number) == [2082, 2082, 2082, None, None]
    assert values(spark, ["2025-07-28 (Monday)", "", "2025", None], dates.label_to_date) == [datetime.date(2025, 7, 28), None, None, None]


def test_other_calendar(spark):
    short = dates.BSCalendar({2081: dates.BS_MONTH_LENGTHS[2081]}, datetime.date(2024, 4, 13))
    df = spark.createDataFrame([("२०८१ चैत्र ३१",), ("२०८२ बैशाख १",)], "x string")
    assert rows(df.select(dates.gregorian_date(F.col("x"), short).cast("string"))) == [("2025-04-13",), (None,)]


def test_calendar_years():
    calendar = dates.BSCalendar()
    starts = calendar.month_starts()
    new_year = {y: starts[12 * (y - calendar.first_year)] for y in calendar.lengths}
    assert [new_year[y] for y in (2070, 2082, 2083)] == [datetime.date(2013, 4, 14), datetime.date(2025, 4, 14), datetime.date(2026, 4, 14)]
    older = dates.BSCalendar.from_rows([(2069, 31, 32, 31, 32, 31, 30, 30, 30, 29, 29, 30, 31), (2070, *calendar.lengths[2070])])
    assert older.first_day == datetime.date(2012, 4, 13) and older.first_year == 2069
