"""Rows that every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, key string, score double"


def awkward(spark, more=()):
    long = "word other thing " * 30_000
    rows = [
        (1, "Some plain words in a row here."),
        (2, "some plain words in a row here."),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, long),
        (7, "one"),
        (7, "one"),
        (8, "É accents STAY É 漢字 😀 nul\x00byte\x1cfs"),
        (None, "no id at all"),
        *more,
    ]
    return spark.createDataFrame([(i, t, None, None, None, 0, "k", 0.5) for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
