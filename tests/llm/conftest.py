import pytest
from pyspark.sql import types as T

ODD = [
    (1, "one two three four five six seven", "en"), (2, None, None), (3, "", "en"), (4, "   \n\t ", "en"),
    (5, "one two three four five six seven", "fr"), (5, "one two three four five six seven", "fr"), (6, "short", "en"),
    (None, "text without a number, one two three", "en"), (7, "É" * 40 + " long " * 3000, "en"), (8, "short", None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, a long text, equal texts,
    a repeated row, and extra columns with names the operators use inside."""
    schema = "doc_id long, text string, lang string, node string, key string, n string, sig string, _salt string"
    return spark.createDataFrame([(i, t, x, "a", None, "b", "c", "d") for i, t, x in ODD], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], T.StructType().add("doc_id", "long").add("text", "string").add("_n", "string"))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
