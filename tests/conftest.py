import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import get_session  # noqa: E402

DATA = Path(os.environ.get("TIDEMARK_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tidemark-tests",
        spark__master="local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
        spark__sql__session__timeZone="UTC",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
