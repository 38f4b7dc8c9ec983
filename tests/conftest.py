import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newslake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4)
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as list of dicts (optionally sorted by a key)."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in ([order] if isinstance(order, str) else order)))
    return out
