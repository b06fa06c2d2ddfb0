import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text) pairs."""
    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)
    return make
