import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemill.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.driver.host": "127.0.0.1", "spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a DataFrame, nulls first."""

    def get(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(type(v)), v) for v in t))

    return get
