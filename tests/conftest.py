import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelscope.session import ensure_checkpoint_dir, get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="panelscope-tests", shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s


def D(y, m, d=12):
    return dt.date(y, m, d)


@pytest.fixture
def dates():
    return D
