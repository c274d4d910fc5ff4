import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from fieldlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 4, **{"spark.driver.memory": "6g", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session
