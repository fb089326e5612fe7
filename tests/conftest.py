import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridplume.session import build_session, work_path  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        # Test data is tiny; let it still be written by several tasks.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="16k",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(spark):
    """Makes fresh paths in the work folder."""
    return lambda name="t": work_path(spark, name)


@pytest.fixture
def setting(spark):
    """Sets a session option for one test."""
    old = {}

    def set_option(key, value):
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield set_option
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
