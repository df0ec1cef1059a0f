import pytest
from pyspark.sql import functions as F


@pytest.fixture
def crowd(spark):
    """Rows as a table in several partitions, with extra columns whose names the operators use themselves."""

    def make(rows, schema, extra=("fp", "node", "component", "size", "target", "rank", "key", "lines", "row", "doc",
                                  "rid", "_text", "copies", "source_size", "page", "host", "vector", "score", "part")):
        df = spark.createDataFrame(rows, schema).repartition(3)
        return df.withColumns({c: F.lit(-1) for c in extra if c not in df.columns})

    return make


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL
