import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("HEARTHLINE_DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from hearthline.session import local_session

    s = local_session("4", "tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not Path(path).exists():
        pytest.skip("no test data here")
    return path
