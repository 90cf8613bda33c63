"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import pytest

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank today", "a"),
    (3, "the quick brown fox jumps over the lazy dog near the river bank today", "b"),
    (4, None, "b"), (5, "", "b"), (6, " \t\n ", None), (7, "one", None), (8, "one", "c"), (9, "two words", "c"),
    (10, LONG, "c"), (11, LONG + " tail", "c"), (12, "Ünï cödé ▁ a  b <|endoftext|> <s> x y", "a"),
    (None, "no id here at all my friend", "a"), (13, "repeated row of words", "é"), (13, "repeated row of words", "é"),
    (14, "a\x0bb\x0cc\x85d \x1c e", "z"), (15, "x" * 70_000, "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", s, len(t or ""), 7, 8, 9.5, "z", 1, 2) for i, t, s in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size int, shard int, score double, "
              "_doc string, target int, _n int").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("doc_id = -1")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (7, 0, 1), (9, 0, 1), (10, 1, 0), (10, 1, 0), (4, 0, 0),
                                  (None, 1, 1), (3, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
