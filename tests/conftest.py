import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("tessera-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from tessera.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-")


@pytest.fixture()
def jobs(spark):
    """the 5-row job table (names with spaces on purpose)."""
    rows = [(1, 5000, 1000, 800, "John", "Mike", "North", "A", "X", "Tom", "Desc1", 200),
            (2, 8000, 2000, 1500, "Jane", "Mike", "South", "B", "Y", "Dick", "Desc2", 500),
            (3, 10000, 3000, 2500, "John", "Steve", "East", "A", "Z", "Harry", "Desc3", 500),
            (4, 12000, 4000, 3200, "Bob", "Steve", "West", "C", "X", "Tom", "Desc4", 800),
            (5, 15000, 5000, 4000, "Jane", "Mike", "North", "B", "Y", "Dick", "Desc5", 1000)]
    cols = ["Job Number", "Job Value", "Total Claimed", "Total Cost", "Estimator", "Foreman", "Job Area",
            "Main Contractor", "Suburb", "Supervisor", "Job Description", "Saving or Loss"]
    return spark.createDataFrame(rows, cols)
