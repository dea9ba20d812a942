"""Small document tables for the tests of the text operators."""

import random

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows, extra=None):
    """Documents from (doc_id, text[, lang, source]); ``extra`` adds columns of the same text value."""
    full = [(r[0], r[1], *(r[2:] or ("en", "s")), None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, COLUMNS)
    for name in extra or []:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def odd_rows():
    """NULLs in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(60_000))
    return [
        (1, None, None, None),
        (None, "a text without an id", "en", "s"),
        (2, "", "en", "s"),
        (3, " \n\t ", None, "s"),
        (4, long, "en", None),
        (5, "same words here again and again", "de", "s"),
        (5, "same words here again and again", "de", "s"),
        (6, "same words here again and again", "de", "s"),
        (7, "\U0001f600 你好 \x00 nul", "fr", "t"),
    ]
