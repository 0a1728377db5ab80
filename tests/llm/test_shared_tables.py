"""Written tables: their rows, the setting they change meanwhile, and their end."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from rollbook.llm.shared import discard, written

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_written_rows_stay_and_the_setting_comes_back(spark):
    before = spark.conf.get(KEY)
    table = written(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    assert spark.conf.get(KEY) == before and table.count() == 7 == table.count()
    with pytest.raises(Exception, match="stopped here"):
        written(spark.range(1).select(F.raise_error(F.lit("stopped here")).cast("int").alias("x")), "test")
    assert spark.conf.get(KEY) == before


def test_discarded_tables_are_gone(spark):
    kept, gone = written(spark.range(5), "test-kept"), written(spark.range(5), "test-gone")
    folder = os.path.dirname(gone.inputFiles()[0]).removeprefix("file://")
    discard(gone)
    assert not os.path.exists(folder) and kept.count() == 5
    discard(written(spark.range(0), "test-empty"))
