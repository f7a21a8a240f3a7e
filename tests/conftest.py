import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    # spark.checkpoint.dir is read from the configuration; build_session
    # creates a private folder only when it is unset.
    s = build_session("local[4]", shuffle_partitions=4, app_name="tessera-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a list of tuples (test helper; fixtures are tiny)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
