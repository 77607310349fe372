"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkprep.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    ship_package(session)
    yield session
    session.stop()
