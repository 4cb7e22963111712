import pytest
from pyspark.sql import functions as F

CLASHING = ("size", "rate", "copies", "fp", "root", "at", "spans", "row_of_copy", "fingerprint_of_copy", "component_id")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text, source) as documents, with extra columns whose names operators use themselves."""
    def make(rows, clashing=True):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").select(
            "doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("bigint").alias("n_chars"))
        for name in CLASHING if clashing else ():
            df = df.withColumn(name, F.lit(name))
        return df.repartition(3)

    return make
