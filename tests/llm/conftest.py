import pytest


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text), with an extra column whose name clashes with inner names."""

    def make(rows, extra="size"):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], f"doc_id long, text string, `{extra}` string")

    return make


@pytest.fixture(scope="session")
def table(spark):
    return lambda name, size="sf0.001": spark.read.parquet(f"/root/testdata/{size}/{name}.parquet")
