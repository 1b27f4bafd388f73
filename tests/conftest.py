import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vocalis.session import clear_workspaces, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    clear_workspaces(session)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
