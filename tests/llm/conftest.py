import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """A frame of documents from texts, or from (doc_id, text, source) rows."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t, "a") for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, None, s, None if t is None else len(t)) for i, t, s in rows], DOCS)

    return make


@pytest.fixture
def tables(spark, tmp_path):
    """Writes frames as the tables of a data folder."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
