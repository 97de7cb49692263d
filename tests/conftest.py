import pytest

from tessera.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="3", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__checkpoint__dir=str(shared), spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
