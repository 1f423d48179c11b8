import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contrail import get_session  # noqa: E402
from contrail.session import clear_work  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app="contrail-tests", shuffle_partitions=8)
    yield s
    clear_work(s)
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def sorted_rows(df):
    """Rows as tuples in a NULL-safe order, for multiset comparisons."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
