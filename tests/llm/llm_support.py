"""Helpers that the tests here import by name; fixtures are in conftest."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    """Documents from (doc_id, text) rows."""
    return spark.createDataFrame([(i, t, "en", "made", len(t or "")) for i, t in rows], SCHEMA)


def prose(seed, n):
    rng = random.Random(seed)
    syllables = ["ta", "ro", "mi", "len", "is", "or", "ka", "the", "on", "ing"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


#: Nulls, empties, blanks, repeated rows, a null id, ties, and one long text.
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, "word"), (5, "two words"), (6, prose(1, 300)), (6, prose(1, 300)), (7, prose(1, 300)),
    (None, prose(2, 120)), (8, prose(1, 300).replace("ta", "TA", 3)), (9, prose(3, 20_000)), (10, "\U0001F600 é ß İ \x1f 中文字"), (11, "a" * 5000),
]


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
