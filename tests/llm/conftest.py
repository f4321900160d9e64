import os

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"

ODD = [
    (None, "a row without an id " * 5, "en", "s1", 1),
    (1, None, "en", "s1", 0), (2, "", "en", None, 0), (3, " \n\t ", "en", "s2", 4),
    (4, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen. " * 3, "en", "s2", 9),
    (5, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen. " * 3, "en", "s2", 9),
    (5, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen. " * 3, "en", "s2", 9),
    (6, "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen", "en", "s3", 9),
    (7, "a " * 40_000, "en", "s3", 9), (8, "x" * 200_000, "en", "s3", 9),
    (9, "Ünïcödé  wörds and  spaces\x1c <|endoftext|> </s> \\~ \\n", "de", "s3", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and very long texts, ties, repeats, and a column named like a result."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, SCHEMA).withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit("mine"))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    return ODD
