import datetime
import random
import re

from pyspark.sql import functions as F

from newsloom.functions import dates, text

YEAR = 2082
WORD = r"[\wऀ-ॿ]+"


def by_hand(sentence):
    """The rewrite with Python's own regular expressions and a day table, as a check."""
    table, day = {}, dates.CALENDAR.first_day
    for y, lengths in dates.CALENDAR.lengths.items():
        for m, n in enumerate(lengths, 1):
            for d in range(1, n + 1):
                table[y, m, d] = day
                day += datetime.timedelta(days=1)

    def swap(pattern, parts):
        def new(match):
            y, name, d = parts(match)
            found = table.get((int(y), dates.NEPALI_MONTHS.get(name), int(d)))
            return found.strftime("%Y-%m-%d (%A)") if found else match[0]

        return lambda s: re.sub(pattern, new, s)

    for old, new in text.WEEKDAYS.items():
        sentence = sentence.replace(old, new)
    for step in (
        swap(rf"(\d{{4}})\s*({WORD})\s*(\d{{1,2}})\s*गते?", lambda m: (m[1], m[2], m[3])),
        swap(rf"({WORD})\s*(\d{{1,2}})", lambda m: (YEAR, m[1], m[2])),
        swap(rf"(\d{{1,2}})\s*({WORD})", lambda m: (YEAR, m[2], m[1])),
    ):
        sentence = step(sentence)
    return sentence.replace("गत", "last")


def test_random_sentences(spark):
    random.seed(7)
    words = [*dates.NEPALI_MONTHS, *text.WEEKDAYS, "गते", "गत", "प्रहरी", "x_1", "2082", "२०८१", "२०८२", "१२", "3", "३१", "९", "2024-05-06", "।", ",", "(", "", "a1b2"]
    gaps = [" ", "", "  ", " ", "\n", ", ", "-"]
    sentences = ["".join(random.choice(words) + random.choice(gaps) for _ in range(random.randint(1, 9))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(sentences)), "i int, s string")
    got = {r.i: r.t for r in df.select("i", text.rewrite_text(F.col("s"), YEAR).alias("t")).collect()}
    wrong = [(s, got[i], by_hand(s)) for i, s in enumerate(sentences) if got[i] != by_hand(s)]
    assert not wrong, wrong[:3]
    assert sum(got[i] != s for i, s in enumerate(sentences)) > 500


def test_examples(spark):
    df = spark.createDataFrame([("यो २०८२ साउन १२ गते सोमबार भयो। साउन १० र १५ भदौ, गत वर्ष",), ("गतेको",), ("",)], "s string")
    got = [r[0] for r in df.select(text.rewrite_text(F.col("s"), YEAR)).collect()]
    assert got == ["यो 2025-07-28 (Monday) Monday भयो। 2025-07-26 (Saturday) र 2025-08-31 (Sunday), last वर्ष", "lastेको", ""]


def test_word_boundary_and_other_words(spark):
    df = spark.createDataFrame([("गत गतेको",)], "s string")
    assert df.select(text.rename_time_words(F.col("s"), word_boundary=True)).first()[0] == "last गतेको"
    assert df.select(text.rename_time_words(F.col("s"), {"गतेको": "of"})).first()[0] == "गत of"


def test_a_run_without_blanks_is_read_once(spark):
    import time

    run = "क" * 1_000_000
    df = spark.createDataFrame([(f"जेठ 5 {run} गते",)], "t string")
    spark.range(1).count()
    start = time.perf_counter()
    got = df.select(text.rewrite_dates(F.col("t"), 2080)).first()[0]
    assert time.perf_counter() - start < 20 and got.endswith(run + " गते") and not got.startswith("जेठ")
