from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tramline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def values(spark):
    """Evaluates expressions over one row of literals."""

    def evaluate(*columns):
        return tuple(spark.range(1).select(*columns).first())

    return evaluate
