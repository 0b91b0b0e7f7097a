from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loanweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as dictionaries, ordered."""
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
