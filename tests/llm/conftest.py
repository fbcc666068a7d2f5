import pytest
from pyspark.sql import functions as F

DOC = "doc_id bigint, text string, lang string, source string, key string, id string, n bigint, kept boolean, _row string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, source[, lang]]), with columns of clashing names."""

    def build(rows):
        full = [(i, t, *(more + [None] * 2)[1::-1][:2]) for i, t, *more in rows]
        full = [(i, t, lang, source, "k", "i", 7, False, "r") for i, t, lang, source in full]
        return spark.createDataFrame(full, DOC)

    return build


def as_dict(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumn("toxic", F.col("toxic").cast("int"))
