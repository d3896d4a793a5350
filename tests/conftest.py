from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakemart.session import local_session
    session = local_session(cores=8, shuffle_partitions=8, app="lakemart-tests")
    yield session
    session.stop()
