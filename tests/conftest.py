import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from countyrisk.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "countyrisk-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "shared"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """``frame("a string, b int", rows…)``."""

    def build(ddl, *rows):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ddl)

    return build


def values(df, column):
    return [r[column] for r in df.select(column).collect()]


def plan_of(df):
    """Physical plan as text, before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()
