import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from featureloom import build_session, drop_staged

    session = build_session(
        "featureloom-tests", "local[8]",
        spark__sql__shuffle__partitions=8, spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_staged(session)
    session.stop()
