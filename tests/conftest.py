from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import SF  # noqa: E402

from flowlab.session import build_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}, "local[4]")
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def frame(spark):
    """Small table from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
