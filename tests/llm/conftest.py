import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, start int, ids string"


def frame(spark, texts):
    """A documents table from texts or (id, text) pairs, with columns whose names operators use themselves."""
    pairs = [pair if isinstance(pair, tuple) else (i, pair) for i, pair in enumerate(texts)]
    return spark.createDataFrame([(i, text, None, "s", None, "x", 1, "y") for i, text in pairs], SCHEMA)


@pytest.fixture
def docs_of(spark):
    return lambda texts: frame(spark, texts)


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, repeated and very long texts, and odd characters."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(400)}" for _ in range(30_000)]
    return [
        None, "", " \n\t ", "one", "two words", "one two three four", "one two three four", "ONE two\x0bthree\x0cfour",
        " ".join(words), " ".join(words[:5000]) + " tail", "İΣ ß é é 한글 \x1c a b", "x" * 30_000,
        "same line\nsame line\n\nsame line \n" * 40, "a@b.co " * 300,
    ]


@pytest.fixture(scope="session")
def small_texts():
    """Texts of the 0.001 tables."""
    import duckdb

    return dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())
