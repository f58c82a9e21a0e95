import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import build_session, scratch_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="ledgerloom-tests", shuffle_partitions=8)
    yield session


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the shared root for one test."""
    return lambda label="t": scratch_path(spark, label)


class conf_override:
    """Set a session conf for a block, then put back whatever was there before."""

    def __init__(self, spark, key, value):
        self.spark, self.key, self.value = spark, key, value

    def __enter__(self):
        self.before = self.spark.conf.get(self.key, None)
        self.spark.conf.set(self.key, self.value)
        return self

    def __exit__(self, *exc):
        if self.before is None:
            self.spark.conf.unset(self.key)
        else:
            self.spark.conf.set(self.key, self.before)
        return False
