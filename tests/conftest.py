import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tablewright-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def people(spark):
    rows = [(1, "Alice", 25, 90.5), (2, "Bob", 30, 85.0), (3, "Cara", 35, 77.25), (4, "Dan", 40, 92.0), (5, "Eve", 45, 88.0)]
    return spark.createDataFrame(rows, "id long, name string, age long, score double")


@pytest.fixture
def customers(spark):
    rows = [
        (25, 40000, "A", "quick red fox", 0),
        (30, 50000, "B", "the red fox runs", 1),
        (35, 60000, "A", "blue sky", 0),
        (40, 70000, "C", "sky and fox", 1),
        (45, 80000, "B", "été çà où", 0),
    ]
    return spark.createDataFrame(rows, "age long, income long, category string, description string, target long")


def make_spec(features, target=("target", "binary"), task=None, **training):
    from tablewright.spec import TableSpec

    doc = {
        "features": [dict(zip(("name", "type", "preprocessing"), f, strict=False)) if isinstance(f, tuple) else f for f in features],
        "target": {"name": target[0], "type": target[1]},
        "training_params": training,
    }
    if task:
        doc["metadata"] = {"task_type": task}
    return TableSpec.from_dict(doc)
