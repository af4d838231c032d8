import random

import pytest

# Extra columns whose names the operators use inside.
CLASHING = "score string, words int, row_no int, names string, size string, spans int, chunk int"


@pytest.fixture
def documents(spark):
    """Make a documents table with extra columns from (doc_id, text[, lang[, source]])."""

    def make(rows, partitions=3):
        full = [(*row, *("en", "a")[len(row) - 2 :])[:4] for row in rows]
        schema = f"doc_id bigint, text string, lang string, source string, {CLASHING}"
        extra = ("x", 1, 2, "y", "z", 3, 4)
        return spark.createDataFrame([(*row, *extra) for row in full], schema).repartition(partitions)

    return make


@pytest.fixture
def awkward():
    """Nulls, empty and very long texts, repeated rows, all kinds of white space."""
    random.seed(5)
    words = ["".join(random.choices("abcdefé", k=random.randint(1, 6))) for _ in range(60)]
    sentence = lambda n: " ".join(random.choices(words, k=n))
    long = sentence(20_000)
    copied = sentence(40)
    return [
        (1, None, None, None),
        (2, "", "en", None),
        (3, " \t\n\x0b\x0c\r ", "en", "a"),
        (4, "one", "en", "a"),
        (5, "one  two\tthree", "fr", "b"),
        (6, long, "en", "b"),
        (7, long + " end", "en", "b"),
        (8, copied, "de", "c"),
        (8, copied, "de", "c"),
        (9, copied.upper(), "de", "c"),
        (10, copied.replace(" ", "\n"), "de", "c"),
        (11, sentence(30) + " " + copied, "de", "c"),
        (None, copied, "de", "c"),
        (12, "x" * 200_000, "en", "a"),
        (13, "a b 　 \x00\x1f c", "es", "a"),
        (14, "😀 " * 50, "es", "a"),
        *[(20 + i, sentence(random.randint(1, 60)), "es", "d") for i in range(30)],
    ]
