import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from rillmark.session import build_session, clear_scratch

    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def entry():
    import __spark_entry__

    return __spark_entry__


def rows(df):
    """Rows as plain tuples, in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
