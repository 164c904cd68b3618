import random

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
CLASHES = ("d", "v", "k", "n", "row", "size", "turn", "gone", "all", "words", "w", "h", "c", "f", "letters", "score", "lang_pred", "taken", "n_lines", "key", "gram", "spans", "label", "tree", "node")


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source) with n_chars and columns whose names the operators use inside."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in CLASHES]
    )
    return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * len(CLASHES)) for r in rows], schema)


def odd_rows():
    rng = random.Random(7)
    vocabulary = [f"{a}{b}{c}" for a in "kmnprst" for b in "aeiou" for c in ("la", "ron", "t", "mis", "ü")]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base = [prose(n) for n in (60, 120, 200, 90)]
    shared = prose(70)
    line = "A line that many documents share, word for word, in all of them"
    rows = [
        (1, base[0], "en", "a"), (2, base[0], "en", "b"), (3, base[1], "de", "a"), (4, base[1].replace(" ", "  ", 3), "de", None),
        (5, base[2], "en", "c"), (6, base[2] + " one more", "en", "c"), (7, prose(30) + " " + shared + " " + prose(40), None, "a"),
        (8, shared + " " + prose(20), "en", "a"), (9, prose(10) + "\t" + shared, "de", "d"), (10, None, None, None), (11, "", "en", "a"), (12, " \n\t ", "en", "b"),
        (13, "word", "en", "b"), (14, "two words", "de", "b"), (15, "1234 !!", "en", "a"), (16, LONG, "en", "a"), (17, LONG + " tail", "en", "e"),
        (18, "same same " * 80, "en", "a"), (19, "same same " * 81, "en", "a"), (None, base[3], "en", "a"), (21, base[3], "en", "a"), (22, base[3], "en", "a"), (22, base[3], "en", "a"),
        *[(30 + i, f"{prose(6)}\n  {line.upper() if i % 2 else line} \n{prose(4)}\n\n{line}", "en", f"s{i}") for i in range(7)],
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return odd_rows()
