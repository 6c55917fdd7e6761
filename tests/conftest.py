import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowtally.schemas import FRAME  # noqa: E402
from flowtally.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "flowtally-tests", master="local[4]", spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__session__timeZone="America/New_York",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Records (dicts) or raw texts -> common frame of one topic."""
    def make(topic, records):
        rows = [
            (topic, r if r is None or isinstance(r, str) else json.dumps(r), topic, 0, i, None)
            for i, r in enumerate(records)
        ]
        return spark.createDataFrame(rows, FRAME)
    return make


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)
