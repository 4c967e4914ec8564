import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from sievelight.session import local_session

    session = local_session("4", "tests", 4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
