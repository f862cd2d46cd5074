import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgermill.session import SETTINGS  # noqa: E402

TESTDATA = "/root/testdata"
#: Known figures of extracts that are not part of this repository: only where their folder is named.
collect_ignore = [] if os.environ.get("LEDGERMILL_EXTRACTS") else ["test_extracts_golden.py"]


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("ledgermill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = os.path.join(TESTDATA, "sf0.01")
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
