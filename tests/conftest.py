import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyroll.session import local_session  # noqa: E402

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = TESTDATA / "sf0.01"
    if not folder.exists():
        pytest.skip("no test tables")
    return str(folder)
