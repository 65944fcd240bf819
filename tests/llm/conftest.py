import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with nulls, empty and long texts, ties, a repeated row and other columns."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [
            (9001, None, "en", None, None), (9002, "", None, "src0", 0), (9003, " \t\n", "en", "src0", 3), (9004, "!!! 123", "fr", "", 7),
            (9005, "word " * 20_000, "en", "src0", 100_000), (9006, "a", "de", "src1", 1), (9006, "a", "de", "src1", 1),
            (None, "no id here at all", "en", "src2", 17), (9007, "É É é ß K İ", None, None, 11),
        ],
        rows.schema,
    )
    return rows.unionByName(odd).withColumn("key", F.lit("x")).withColumn("fp", F.lit(1)).withColumn("n", F.lit(2)).cache()


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
