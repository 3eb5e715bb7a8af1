import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (HERE, os.environ.get("PYTHONPATH"))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    at = tempfile.mkdtemp()
    s = SparkSession.builder.master("local[4]").config(map={"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"{at}/shared", "spark.sql.warehouse.dir": f"{at}/warehouse", "spark.driver.memory": "3g"}).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
