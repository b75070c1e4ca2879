import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskframe.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8,
        "riskframe-tests",
        **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="riskframe-warehouse-")},
    )
    yield session
    session.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
