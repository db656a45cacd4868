import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from degraus import get_session

    session = get_session(
        app="degraus-tests", master="local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema -> DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
