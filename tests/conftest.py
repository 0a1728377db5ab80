import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a column function to a list of inputs and return the outputs in order."""
    from pyspark.sql import functions as F

    def run(function, inputs, schema="x string"):
        rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(inputs)]
        df = spark.createDataFrame(rows, "i int, " + schema)
        names = [c for c in df.columns if c != "i"]
        out = df.select("i", function(*[F.col(c) for c in names]).alias("out")).orderBy("i").collect()
        return [r["out"] for r in out]

    return run
