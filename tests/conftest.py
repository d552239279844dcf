from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("TZ", "UTC")
    from pyspark.sql import SparkSession

    from shoptide import configure

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("shoptide-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        # Tests have no cluster to name a shared folder.
        .config("spark.checkpoint.dir", str(shared / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf001():
    folder = TESTDATA / "sf0.01"
    if not folder.exists():
        pytest.skip("test tables not present")
    return str(folder)
