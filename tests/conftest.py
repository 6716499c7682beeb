import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from obsflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Clean observations from (station, time, tmpf[, relh, vsby]) tuples."""

    def make(items):
        full = [(s, t, *(list(v) + [0.5, 0.1])[:3]) if len(v) < 3 else (s, t, *v) for s, t, *v in items]
        df = spark.createDataFrame(full, "station string, valid string, tmpf double, relh double, vsby double")
        return df.selectExpr("station", "cast(valid as timestamp) valid", "tmpf", "relh", "vsby")

    return make
