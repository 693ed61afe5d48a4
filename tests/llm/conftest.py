import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a DataFrame of a given schema."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
