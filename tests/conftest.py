import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def make_session() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="headrace-test-")
    session = (SparkSession.builder.master("local[8]").appName("headrace-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.scheduler.mode", "FAIR")
               .config("spark.sql.maxMetadataStringLength", "10000")
               .config("spark.checkpoint.dir", f"{folder}/shared")
               .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
