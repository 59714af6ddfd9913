import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import checkpoint_dir, local_session

    s = local_session(4, shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s, tempfile.mkdtemp(prefix="shelfwise-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shelfwise-test-")
