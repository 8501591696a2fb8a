"""Rows that every operator must take: nulls in any column, empty and long texts, ties, repeats, clashing extra columns."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_key string, _text string, _row string, _node string, _part string, _lines string, _removed string, component string"
)
EXTRA = ("x",) * 8
PROSE = "The quick fox runs over the old stone bridge and looks for food near the calm river bank"


def odd_documents(spark, more=()):
    texts = [
        (0, None, None, None), (1, "", "en", "a"), (2, "   \n\t ", "en", None), (3, "word", "en", "a"), (None, PROSE, "en", "b"),
        (None, None, None, None), (4, PROSE, "en", "a"), (4, PROSE, "en", "a"), (5, PROSE + " today", "en", "b"),
        (6, "été ñandú 東京 😀 \u0000 end", "fr", "c"), (7, "lang " * 40_000, "en", "a"), (8, "123 !!! ...", None, "c"), (9, PROSE, None, "c"),
    ]
    rows = [(d, t, lang, s, None if t is None else len(t), *EXTRA) for d, t, lang, s in [*texts, *more]]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return odd_documents(spark).limit(0)


def by(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
