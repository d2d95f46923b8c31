import pytest


@pytest.fixture
def frame(spark):
    """rows (list of tuples) and a DDL schema -> DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
