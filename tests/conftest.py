import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from silsila.session import get_session

    session = get_session("local[4]", 4, **{"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.sql.legacy.javaCharsets": "true"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return os.environ.get("SILSILA_TEST_DATA", "/root/testdata/sf0.001")
