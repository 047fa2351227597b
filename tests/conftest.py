"""One local session for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from hierarq.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():  # noqa: ANN201
    s = build_session("local[4]", shuffle_partitions=4, driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return "/root/testdata/sf0.001"
