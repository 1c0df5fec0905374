import datetime as dt
import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def hard_documents(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, clashing and more columns."""
    rng = random.Random(4)
    words = "the of and nd rer sheon der die und ung la de que ción año mit license http a b".split()
    texts = [
        None, "", " ", "\n\n", "?!", "12 34", "é", "word", "the the the", "a b c d e f a b c d e f",
        "x\ny\nx\n x\nx", "Released under the MIT License.", "mit license mit license", " lead and trail ",
        "Two  blanks\tand\rtabs\x0band\x0cmore", "no break  wide 中文 文字",
        " ".join(rng.choice(words) for _ in range(30_000)), "long" * 20_000,
    ]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    rows = []
    for n, text in enumerate(texts):
        rows.append((n, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "", None]), n, 1.5, "x", n))
    rows += [rows[7], rows[7], rows[9]]  # whole rows that repeat
    rows += [(3, "another text of the same id", "en", "s1", 1, None, None, None)]
    rows += [(None, "the of and nd without an id", None, None, None, None, None, None)] * 2
    rows += [(None, None, None, None, None, None, None, None)]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, rank string, size long"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(hard_documents):
    return hard_documents.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def hard_labels(spark):
    rows = [(n, n % 2, 0) for n in range(20)] + [(1, 0, 0), (2, None, 1), (None, 1, 0), (5, 7, 0), (900, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def words_of(text):
    return (text or "").encode().split()


__all__ = ["SF", "dt", "words_of"]
