import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from shopgrain import scratch  # noqa: E402
from shopgrain.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    scratch.release(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def rows(df, *columns):
    """Rows as a sorted list of tuples, for frames of a few rows."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
