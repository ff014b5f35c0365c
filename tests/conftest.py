import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture
def tmp_dir():
    # a fresh folder per test; never cleared with rm
    return tempfile.mkdtemp(prefix="dockhand-test-")


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()),
                  key=lambda t: tuple((x is None, 0 if x is None else x) for x in t))
