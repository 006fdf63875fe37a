import os
import sys

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import local_session

    session = local_session(4, 4, "tests", "2g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
