import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tabprep.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app_name="tabprep-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect in a stable order as plain tuples."""
    cols = cols or tuple(df.columns)
    return [tuple(r) for r in df.select(*cols).collect()]
