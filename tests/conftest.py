import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tslines import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.get_spark("tests", master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
