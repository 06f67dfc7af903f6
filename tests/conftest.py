import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tadkit.session import BASE_CONF, checkpoint_dir
    b = SparkSession.builder.master("local[*]").appName("tadkit-tests") \
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g") \
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tadkit-test-warehouse-"))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tadkit-test-ckpt-"))
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def entry_module():
    import importlib.util
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m
