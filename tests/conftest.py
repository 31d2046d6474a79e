import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    root = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.checkpoint.dir", str(root / "work"))
               .config("spark.sql.warehouse.dir", str(root / "warehouse"))
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from millrace.workload.registry import prepare

    prepare(session)
    yield session
    session.stop()


@pytest.fixture
def small():
    return SMALL
