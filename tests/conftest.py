import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from needlens.session import build_session
    s = build_session("local[4]", 4, app_name="needlens-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (of the given columns), sorted."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
