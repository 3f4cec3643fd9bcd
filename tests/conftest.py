import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def fleet(spark):
    """Three vehicles: two classes, a subclass across both, a keyword of two records, order of names unlike that of display names."""
    rows = [
        ("A01", "Zeta", "Heavy Tanks", ["Autoloaders"], "USSR", 8, ["Angle the hull.", "Hold the ridge."], ["hull-down", "sidescraping"]),
        ("B01", "Alpha", "Heavy Tanks", [], "Germany", 7, ["Hold the ridge."], ["view range"]),
        ("C01", "Mid", "Light Tanks", ["Autoloaders"], "USA", 6, ["Scout ahead."], ["view range"]),
    ]
    return spark.createDataFrame(rows, "name string, display_name string, class string, subclasses array<string>, nation string, tier int, strategies array<string>, keywords array<string>")
