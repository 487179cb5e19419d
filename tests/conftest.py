import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import build_session

    # spark.checkpoint.dir comes from the environment when set; build_session
    # makes a private one only when it is unset
    s = build_session("local[8]", app_name="kestrel-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="kestrel-test-")
