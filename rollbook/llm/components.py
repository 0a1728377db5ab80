"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.shared import written


def _around(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both directions of the edges, and the least node around each node, itself included."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
    return both, least


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v long); root is the least node that edges lead to.

    Every round is a written table, so lost executors cost one round at most. The edges of a hub are
    joined with a written table of minima, which adaptive execution can split. Nulls are not edges.
    """
    now = written(edges.toDF("u", "v").where("u <> v").distinct(), "components-edges")
    before = None
    while True:
        both, least = _around(now)
        large = both.where("v > u").join(least, "u").select("v", "m").where("v <> m").toDF("u", "v").distinct()
        large = written(large, "components-large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = written(down.groupBy("u").agg(F.min("v").alias("m")), "components-least")
        small = down.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        now = written(small, "components-edges")
        # Two rounds with the same edges: all are stars around their roots.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
