import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tributary import build_session
    s = build_session("local[4]", 4, app_name="tributary-tests")
    yield s
    s.stop()
