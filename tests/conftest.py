import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from salesguard.session import build
    s = build("local[4]", shuffle_partitions=4,
              extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sg-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sg-test-")
