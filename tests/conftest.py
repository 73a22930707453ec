import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from campfin.session import local_session, ship_package
    s = local_session(4, shuffle_partitions=4, app="campfin-tests")
    ship_package(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of ``cols`` (all columns when none given)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(map(str, t)))
