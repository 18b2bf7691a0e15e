import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[*]").appName("strata-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-test-ckpt-"))
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
