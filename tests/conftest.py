import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from promo_engine.session import checkpoint_dir, local_session
    s = local_session("*", 8, "promo_tests")
    checkpoint_dir(s)  # unset in tests -> a private temp folder
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF0001
