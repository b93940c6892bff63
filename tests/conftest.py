import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace import catalog  # noqa: E402
from millrace.session import local_session, prepare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session(8, "millrace-tests"))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def given(spark):
    return catalog.Inputs(spark, SF_DIR)
