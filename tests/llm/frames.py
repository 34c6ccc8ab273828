"""Small inputs: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}{'abcdefg'[r.randrange(7)]}" for _ in range(n))


def edge_texts():
    long_ = words(3000, 5)
    return [(1, "one two three"), (2, None), (3, ""), (4, long_), (4, long_), (None, "no id here " + words(70, 9)),
            (6, words(80, 6)), (7, words(80, 6)), (8, "  \n\t "), (9, "Ünï çode, ÀÉ 123. " + words(60, 8))]


SCHEMA = "doc_id long, text string, lang string, row string, n string"


def documents(spark, texts):
    """Extra columns carry names that operators use inside."""
    return spark.createDataFrame([(i, t, "en", "x", "y") for i, t in texts], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
