from __future__ import annotations

import pytest

AWKWARD = [
    # (doc_id, text, lang, source, n_chars): nulls in any column, empty and blank texts, repeated rows and ids
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 70),
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 70),
    (2, "the quick brown fox jumps over the lazy dog near the old river bank today", "en", None, 70),
    (2, "quite another text under the same id", "en", "b", 36),
    (3, None, "en", "a", 0),
    (4, "", None, "b", 0),
    (5, " \t\n\x0b\x0c\r ", "en", "c", 7),
    (None, "The quick brown fox jumps over the lazy dog near the old river bank today", None, "c", 70),
    (None, None, None, None, None),
    (6, "word " * 30000, "en", "c", 150000),
    (7, "x", "de", "a", 1),
    (8, "Ein kurzer Satz über Äpfel\n\nEin kurzer Satz über Äpfel", "de", "a", 50),
    (-9, "password = hunter2hunter2 and AKIA" + "Z" * 16 + " end", "en", "a", 60),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    from quitanda.llm.common import workers_find_package
    workers_find_package(spark)
    return spark.createDataFrame(AWKWARD, DOC_SCHEMA)


@pytest.fixture(scope="session")
def empty_docs(spark):
    from quitanda.llm.common import workers_find_package
    workers_find_package(spark)
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    from quitanda.llm.common import workers_find_package
    workers_find_package(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


CLASHING = ["node", "comp", "keys", "h", "at", "size", "key", "cell", "label", "words", "line", "score", "kinds",
            "text_key", "u", "v", "_n", "_d", "_c"]


@pytest.fixture(scope="session")
def clashing(awkward):
    """The awkward table with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    return awkward.withColumns({c: F.lit("mine") for c in CLASHING})


def as_dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
