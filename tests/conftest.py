import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dayloom.session import local_session, shared_dir


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="4g")
    shared_dir(session)
    return session


@pytest.fixture
def rows():
    """Collected rows as plain tuples, sorted."""

    def collect(df, *columns):
        found = df.select(*columns).collect() if columns else df.collect()
        return sorted([tuple(r) for r in found], key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect
