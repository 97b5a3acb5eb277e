import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from support import SF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from gable.runtime import build_session

    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from gable.plans.warehouse import warehouse

    return warehouse(spark, SF)
