import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Nulls, empty and white-space texts, a repeated row, and one long text of one word.
ODD = [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", "en", "x", 0), (3, " \n\t ", None, "x", 4), (4, "one two three", "en", "x", 13),
       (4, "one two three", "en", "x", 13), (5, "word " * 5000, "en", "x", 25000), (6, "É漢 🙂 <|endoftext|> </s> ▁ x", "fr", "y", 20)]


@pytest.fixture
def odd(spark):
    """Odd rows, with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    return spark.createDataFrame(ODD, DOC).withColumn("size", F.lit("own")).withColumn("kept", F.lit("own")).withColumn("n", F.lit(1))


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")
