import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from truetally.session import local_session
    s = local_session("4", shuffle_partitions=4, app="truetally-tests")
    yield s


@pytest.fixture(scope="session")
def x(spark):
    """Lazy RAW + conformed frames over the sf0.001 driver tables."""
    from truetally.plans.keys import ctx
    return ctx(spark, SF001, materialize=False)
