import pytest

from tests.conftest import spark  # noqa: F401 - the session of all tests

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture(scope="session")
def documents(spark):  # noqa: F811
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):  # noqa: F811
    """Nulls in every column, empty and very long texts, ties, repeated rows and
    columns named like results and internals."""
    from pyspark.sql import functions as F

    words = "the quick brown fox jumps over the lazy dog while seven wizards mix potions"
    long = " ".join(f"{words} {i}" for i in range(4000))
    rows = [(1, words), (2, words), (2, words), (3, None), (4, ""), (5, " \n\t "), (6, long), (None, words), (7, "a" * 60000),
            (8, "ünïcödé " * 20), (9, "123 456 !!"), (None, None), (10, words + " once more"), (11, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("n_tokens", "score", "kept", "n_bytes", "__id", "__text", "__n", "__row", "node", "id", "bucket", "held_out",
                 "n_words", "token_ids"):
        df = df.withColumn(name, F.lit("clash"))
    return (df.withColumn("lang", F.when(F.col("doc_id") % 4 != 0, F.lit("en"))).withColumn("source", F.lit(None).cast("string"))
            .withColumn("n_chars", F.length("text").cast("long")).cache())


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
