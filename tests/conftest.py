from __future__ import annotations

import pytest

from airstrata.session import local_session
from airstrata.sources.store import Store


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))
