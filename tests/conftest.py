import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from geotally.session import get_session  # noqa: E402

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = get_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(warehouse),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
