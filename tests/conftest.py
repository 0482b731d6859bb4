import pytest

from saltmarsh.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", 4, spark__driver__memory="4g", spark__sql__adaptive__coalescePartitions__parallelismFirst="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
