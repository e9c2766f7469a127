import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from loglattice.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "loglattice-tests", "4g")
    yield session
    session.stop()


def plan_text(df) -> str:
    """The physical plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()
