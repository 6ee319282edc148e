import sys
from pathlib import Path

import pytest

for folder in (Path(__file__).resolve().parents[1], Path(__file__).resolve().parent):
    sys.path.insert(0, str(folder))

from rollcall.plans.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()
