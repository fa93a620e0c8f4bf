from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from usageledger.context import REPORT_SERVICE_ROLE, ReportContext  # noqa: E402
from usageledger.session import local_session  # noqa: E402

SMALL = os.environ.get("USAGELEDGER_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("work"))
    session = local_session(4, 4)
    yield session
    session.stop()


@pytest.fixture()
def ctx():
    return ReportContext(as_of=datetime(2024, 2, 10, 8), user="ann", roles=("R1", REPORT_SERVICE_ROLE))


@pytest.fixture()
def folder():
    return SMALL


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: [(x is None, str(x)) for x in t])
