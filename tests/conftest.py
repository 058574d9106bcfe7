import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    s = build_session("local[4]", app="tessera-tests", shuffle_partitions=4)
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
