from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from municipia import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Sorted plain tuples of a frame."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
