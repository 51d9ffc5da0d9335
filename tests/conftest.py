import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from userlens.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]
