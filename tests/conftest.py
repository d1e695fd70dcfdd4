import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wattline.session import get_session
    s = get_session("local[4]", 4, app_name="wattline-tests", driver_memory="8g")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wattline-test-ckpt-"))
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="wattline-test-")


def write(path, text, encoding="latin-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))
