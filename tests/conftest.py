import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tabml.session import local_session  # noqa: E402
from tabml.sources.staging import drop_stages  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", app="tabml-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    drop_stages(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
