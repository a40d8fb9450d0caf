import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF


#: Documents for edge cases: nulls, empty and very long texts, ties, repeated rows, columns that clash.
@pytest.fixture()
def odd_docs(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, words, "en", "a", 5),
        (2, words, "en", "a", 5),
        (2, words, "en", "a", 5),
        (2, "other text for one id " + words, "en", None, None),
        (None, "text of no id, " * 12, None, "b", 1),
        (None, None, None, None, None),
        (3, None, "en", "b", 0),
        (4, "", "en", "b", 0),
        (5, " \n\t ", "de", "b", 4),
        (6, "short one", "de", "b", 9),
        (7, " ".join(f"long{i % 9000}x" for i in range(30000)), "en", "c", 1),
        (8, "a" * 3000, "en", "c", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    for name in ("score", "copies", "th", "size", "class_id", "rank", "stats", "shard"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.where("false")
