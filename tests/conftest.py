import os
import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
# Python workers import the functions under test by name
os.environ["PYTHONPATH"] = os.pathsep.join(sys.path[:2])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "6g")
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from evidence.session import configure
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
