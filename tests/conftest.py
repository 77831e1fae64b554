import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from fleetscope import get_session
    ckpt = tempfile.mkdtemp(prefix="fleetscope-test-ckpt-")
    s = get_session("local[*]", app="fleetscope-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
