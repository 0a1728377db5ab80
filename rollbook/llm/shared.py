"""What the operators share: written intermediate tables, free column names, words and lines of a text."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.session import shared_folder

#: The six white-space characters of the contracts: blank and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder.

    Cuts the lineage in a way that outlives lost executors, and gives a join a plain
    scan on that side, so that adaptive execution can split a hot key. What was shuffled
    for it is let go once the table is there.
    """
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = shared_folder(spark, purpose), spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a ``written`` table that nothing will read again."""
    spark = table.sparkSession
    for file in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Inside, jobs send at most ``rows`` rows at a time to Python; whole texts make the default of 10,000 heavy."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of the frame has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def words(text: Column) -> Column:
    """The maximal runs without white space; no words for null or blank text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[ \\t-\\r]+"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), 0)


def normal_lines(text: Column) -> Column:
    """Lines compared as one: lower case, numbers as 0, white space at both ends cut."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[0-9]+", "0")
    return F.transform(F.split(plain, "\n"), lambda x: F.btrim(x, F.lit(SPACE)))


def longest(lines: Column) -> Column:
    """The longest line, of equals the last in binary order: near copies of a text mostly share it."""
    return F.array_max(F.transform(lines, lambda x: F.struct(F.length(x).alias("n"), x.alias("line"))))["line"]
