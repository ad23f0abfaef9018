import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lagframe.session import checkpoint_dir, configure
    s = (SparkSession.builder.master("local[*]").appName("lagframe-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lagframe-test-ckpt-"))
    checkpoint_dir(s)
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="lagframe-test-")
