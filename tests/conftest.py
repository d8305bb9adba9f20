from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marketlake.session import build_session

    session = build_session("local[*]", app_name="marketlake-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
