import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, shuffle_partitions=4, memory="4g")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as a sorted list of dicts."""

    def collect(df, *order):
        out = [r.asDict() for r in df.collect()]
        return sorted(out, key=lambda r: tuple((r[c] is None, str(type(r[c])), r[c]) for c in order)) if order else out

    return collect
