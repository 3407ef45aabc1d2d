import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import build_session

    session = build_session("tests", "local[8]", 2)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
