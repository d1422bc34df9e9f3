from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        # Only tests set their own; a cluster names it in spark.checkpoint.dir.
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="catrec-ckpt-", dir="/tmp"))
    yield session


@pytest.fixture
def scratch() -> str:
    """A fresh directory per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="catrec-test-", dir="/tmp")
