import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arrivals_mart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="arrivals_mart_tests")
    yield s


def rows(df, *cols):
    """Collect selected columns as sorted tuples (nulls first)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
