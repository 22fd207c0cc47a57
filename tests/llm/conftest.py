import pytest


@pytest.fixture()
def frame(spark):
    """Rows to a DataFrame: ``frame("a long, b string", rows)``."""
    def make(schema, rows=()):
        return spark.createDataFrame(list(rows), schema)
    return make
