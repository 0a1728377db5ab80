"""Set operations on rows and on names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def stack(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(sources: list[tuple[DataFrame, str]], name: str, across: bool = False) -> DataFrame:
    """Distinct values of several columns; ``across`` also removes repeats between them."""
    parts = [df.select(F.col(c).alias(name)).distinct() for df, c in sources]
    union = reduce(lambda a, b: a.unionByName(b), parts)
    return union.distinct() if across else union


def names_missing(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Names of the left side that the right side lacks, blanks ignored."""
    bare = lambda df: df.select(F.replace(F.col(column), F.lit(" "), F.lit("")).alias(column))
    return bare(left).subtract(bare(right))


def institute_mix(govt: Column, pvt: Column, listed: Column) -> Column:
    """Govt or Pvt when all listed institutes are of that kind, Mix for both kinds, else null."""
    return (
        F.when(listed == 0, F.lit(None).cast("string"))
        .when(govt == listed, "Govt").when(pvt == listed, "Pvt").when((govt > 0) & (pvt > 0), "Mix")
    )


def mix_by(df: DataFrame, keys: list[str], name: str, kind: str, govt: str = "Govt.", pvt: str = "Pvt.") -> DataFrame:
    """The institute mix of each applicant's named options."""
    named = F.col(name).isNotNull()
    counts = df.groupBy(*keys).agg(
        F.count_if(named & F.coalesce(F.col(kind) == govt, F.lit(False))).alias("_g"),
        F.count_if(named & F.coalesce(F.col(kind) == pvt, F.lit(False))).alias("_p"),
        F.count_if(named).alias("_n"),
    )
    return counts.select(*keys, institute_mix(F.col("_g"), F.col("_p"), F.col("_n")).alias("mix"))
