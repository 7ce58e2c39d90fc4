import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (or (doc_id, text) pairs), with columns whose names operators use inside."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("tag", T.StringType()), T.StructField("n", T.StringType()), T.StructField("rep", T.StringType())])

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), "x", None, "r") for i, t in rows], schema).repartition(3)

    return make
