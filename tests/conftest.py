"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    """A session with few partitions."""
    from biblioweave.session import local_session

    return local_session(cores=4, shuffle_partitions=4)
