import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from sightline.session import local_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    return session


@pytest.fixture()
def rows(spark):
    """Rows of a frame as sorted tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [str(x) for x in t])

    return collect
