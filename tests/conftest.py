import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mixtape.session import get_session
    session = get_session(
        "local[4]", app="mixtape-tests", shuffle_partitions=4,
        conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
              "spark.checkpoint.dir": tempfile.mkdtemp(prefix="mixtape-test-ckpt-"),
              "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_smoke():
    if not os.path.isdir(SF_SMOKE):
        pytest.skip("test data not present")
    return SF_SMOKE
