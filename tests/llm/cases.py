"""Rows that every training-data operator must take: nulls, empty, long, ties, repeats, clashing columns."""

SF = "/root/testdata/sf0.001"
LONG = "word and another one, " * 3000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _text string, fp long, block int, k1 long, h1 long, a string, gone int"


def messy(spark):
    rows = [(1, "The cat sat on the mat and looked at the dog for a very long while."), (2, None), (3, ""), (4, "  \n\t \n"), (None, "no id here, but a text"),
            (5, LONG), (6, "The cat sat on the mat and looked at the dog for a very long while."), (6, "The cat sat on the mat and looked at the dog for a very long while."),
            (7, "12 34 !!"), (8, "é ñ 漢字 \U0001f600 \\ <s> [INST]"), (None, None)]
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), i, "x", 0, 0, 0, 0, "y", 0) for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
