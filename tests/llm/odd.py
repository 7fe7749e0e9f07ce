"""Rows that every operator on texts must take: nulls, empties, repeats, long
texts, extra columns whose names clash with results."""

LONG = "word " * 60_000 + "x" * 60_000
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "same text"), (4, "same text"), (None, "no id here"), (5, LONG),
    (6, "\U0001f600 é ñ ß 漢字 \x00 ok"), (None, None),
]


def odd_table(spark, more=()):
    rows = [(d, t, "clash", 7) for d, t in [*ODD, *more]]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, score int")


def empty_table(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def alike_under_overflow(levels=10):
    """Two words of a and b, of 2 ** levels letters, equal to every polynomial of
    an odd base modulo 2 ** 64: a Thue-Morse word and its complement."""
    word = "a"
    for _ in range(levels):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))
