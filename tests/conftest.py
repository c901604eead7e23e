import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from txstream.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_TEST = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from txstream.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
