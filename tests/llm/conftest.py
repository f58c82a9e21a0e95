import pytest

from tests.conftest import scratch, spark  # noqa: F401


@pytest.fixture(scope="session")
def rows(spark):  # noqa: F811
    """``rows(schema, list of tuples)``: a small DataFrame over a few partitions."""
    return lambda schema, data, parts=3: spark.createDataFrame(data, schema).repartition(parts)
