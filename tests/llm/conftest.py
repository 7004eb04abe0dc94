import pytest


@pytest.fixture
def table(spark):
    """A small table from rows and a schema, in several partitions."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        return df.repartition(3) if rows else df

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
