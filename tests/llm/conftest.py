import pytest


def words(n, seed=0, size=4000):
    import random
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, and
    columns whose names the operators use themselves."""
    long_text = words(30_000, 5) + "\n" + "x" * 100_000
    rows = [(1, words(80, 1), "en", "b", 1, "k"), (2, None, None, None, None, None), (3, "", "en", "a", 0, "k"),
            (None, words(60, 2), "en", "b", 2, None), (4, long_text, "en", "b", 3, "k"), (1, words(80, 3), "en", "a", 4, "k"),
            (5, words(70, 4), "en", "b", 5, "k"), (5, words(70, 4), "en", "b", 5, "k"), (6, " \t\n ", "en", "c", 6, "k"),
            (7, "é\u00a0ß\u2003ü <|endoftext|> a  b\n\n c", "fr", "b", 7, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long, `_k1 x.y` string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 8)] + [(None, 1, 0), (3, None, None), (1, 0, 0), (5, 7, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
