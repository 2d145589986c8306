from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from comptoir.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    from checks.standins import Tables

    return Tables(spark, SF)


def rows(df, *order):
    """Rows as tuples, sorted so that missing values do not get in the way."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
