import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tatemono.session import local_session  # noqa: E402
from tatemono.sources import scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    scratch.remove_tables(session)
    session.stop()


@pytest.fixture
def never_broadcast(monkeypatch):
    """Make every measured size count as too large to broadcast."""
    monkeypatch.setattr(scratch, "BROADCAST_BYTES", -1)
