import os
import tempfile

import pytest

from tallybook.session import get_spark


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYTHONPATH", os.getcwd())
    s = get_spark("tests", master="local[8]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tallybook-test-")
