import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from roamgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "roamgrid-tests")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
