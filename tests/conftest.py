import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session
    s = build_session("local[4]", app="quire-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()
