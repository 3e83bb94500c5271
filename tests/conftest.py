import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from driftwood.session import checkpoint_dir, get_spark

    s = get_spark("local[4]", shuffle_partitions=4, app_name="driftwood-tests")
    checkpoint_dir(s)
    yield s
    s.stop()
