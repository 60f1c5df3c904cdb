import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from perkline.session import build_session
    session = build_session(
        "perkline-tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """Collected rows as sorted tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(v) for v in r))
    return collect
