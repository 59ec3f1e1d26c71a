from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from layerflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "layerflow-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, tmp_path):
    """A folder for one test's writes (tests set their own checkpoint folder)."""
    return str(tmp_path)
