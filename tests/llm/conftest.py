import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
#: names that the operators use for columns of their own
CLASHING = ["kept", "score", "digest", "entity", "row_id", "n", "id", "rate", "copy", "label", "keep", "rows"]


@pytest.fixture
def docs_of(spark):
    """documents from (doc_id, text) pairs, with clashing extra columns on demand."""

    def make(rows, extra=False):
        df = spark.createDataFrame(rows, DOCS)
        if extra:
            from pyspark.sql import functions as F

            for c in CLASHING:
                df = df.withColumn(c, F.lit("x"))
        return df

    return make


@pytest.fixture
def words():
    """A seeded generator of words."""
    r = random.Random(11)
    vocabulary = [a + b + c for a in ("th", "on", "er", "") for b in ("an", "re", "st", "i") for c in ("ed", "ly", "s", "tion")]
    return lambda n: [r.choice(vocabulary) for _ in range(n)]


#: null, empty, white space only, repeated rows, a null id, a very long text
def odd_rows(words):
    long = " ".join(words(3000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two three"), (4, "one two three"), (5, "one  two\nthree "),
        (None, "one two three"), (6, long), (7, long), (8, long + " end"), (9, "x"), (10, "é ñ ß 😀 中文"),
    ]
