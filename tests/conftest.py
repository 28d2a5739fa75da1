import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartlens.session import build_session  # noqa: E402

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "cartlens-tests", shuffle_partitions=4,
                            conf={"spark.driver.memory": "4g"})
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartlens-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf001():
    path = SF["0.001"]
    if not os.path.isdir(path):
        pytest.skip("test tables not present")
    return path
