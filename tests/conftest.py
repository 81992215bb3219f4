import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from grainmill.session import get_session

    s = get_session("tests", cpus=8, shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.session.timeZone", "UTC")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
