import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from feedcat.session import get_spark
    s = get_spark(app="feedcat-tests", master="local[*]", shuffle_partitions=8)
    yield s


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
