import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls, empty, blank, ties, repeated rows, a very long text.
WORDS = [f"w{i}" for i in range(400)]
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "one two three four five six", "en", "a", 27),
    (4, "one two three four five six", "en", "a", 27),
    (5, "One TWO three four five six", "de", "b", 27),
    (None, "no id here at all", "en", "b", 17),
    (6, " ".join(WORDS), "en", None, 1),
    (7, " ".join(WORDS[:-3]), None, "b", 1),
    (8, "x" * 40_000, "en", "b", 40_000),
]


@pytest.fixture()
def odd(spark):
    """Odd rows, with an extra column whose name results use too."""
    return spark.createDataFrame(ODD, DOCS).withColumn("score", F.lit("mine"))


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOCS)
