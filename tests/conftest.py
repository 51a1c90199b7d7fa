from __future__ import annotations

import os

import pytest

from tripgrid.session import build_session, release_scratch

TESTDATA = os.environ.get("TRIPGRID_TESTDATA", "/root/testdata")
SMALL = f"{TESTDATA}/sf0.001"
MEDIUM = f"{TESTDATA}/sf0.01"


def make_session():
    spark = build_session(
        "tripgrid-tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    release_scratch(session)
    session.stop()
