import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cabline.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="cabline-tests", shuffle_partitions=8)
    checkpoint_dir(s)   # uses spark.checkpoint.dir when the environment sets one
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cabline-test-")
