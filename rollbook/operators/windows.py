"""Per-group rows and values.

Only ``row_number``/``rank`` with a limit use a window: Spark then keeps the
best rows of every group before the shuffle, so a huge group stays small.
Group counts and maxima are aggregates joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollbook.operators.aggregate import with_keys


def first_rows(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group; ``order`` should be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_rows(df: DataFrame, keys: list[str], order: list, k: int, ties: bool = False, rank_as: str | None = None) -> DataFrame:
    """The first k rows of each group, or all rows ranked k or better."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rk", (F.rank() if ties else F.row_number()).over(w)).where(F.col("_rk") <= k)
    return ranked.withColumnRenamed("_rk", rank_as) if rank_as else ranked.drop("_rk")


def top_overall(df: DataFrame, order: list, k: int) -> DataFrame:
    """The k best rows; finish ``order`` with key columns to break ties."""
    return df.orderBy(*order).limit(k)


def top_overall_with_ties(df: DataFrame, measure: str, k: int) -> DataFrame:
    """All rows whose measure reaches the k-th best value.

    The k-th value comes from a distributed top-k, never from one sorted partition.
    """
    best = df.where(F.col(measure).isNotNull()).select(measure).orderBy(F.desc(measure)).limit(k)
    bound = best.agg(F.min(measure)).scalar()
    return df.where(F.col(measure) >= bound)


def with_group_value(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """An aggregate of each group on all its rows; rows with null keys get null."""
    per_group = with_keys(df, keys).groupBy(*keys).agg(value.alias(name))
    return df.join(per_group, keys, "left")


def with_group_values(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """Several aggregates of each group on all its rows, from one aggregate and one join."""
    per_group = with_keys(df, keys).groupBy(*keys).agg(*[v.alias(n) for n, v in values.items()])
    return df.join(per_group, keys, "left")


def best_status_rows(df: DataFrame, keys: list[str], rank: Column, tie_break: list[str]) -> DataFrame:
    """The row with the highest status rank per group."""
    return first_rows(df, keys, [rank.desc(), *tie_break])


def change_on_previous(df: DataFrame, by: list[str], order: str, value: str, name: str = "growth_pct") -> DataFrame:
    """Percent change on the previous row; for aggregated tables, one row per period."""
    w = Window.partitionBy(*by).orderBy(order)
    before = F.lag(value).over(w)
    return df.withColumn(name, F.try_divide(F.col(value) - before, before) * 100)


def sequence_class(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Whether a group's numbers run from 1 to their maximum.

    ``status`` looks at the set of numbers and at missing ones; ``exact`` also
    wants every number only once.
    """
    n = F.col(number).try_cast("int")
    sums = with_keys(df, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count(n).alias("filled"), F.max(n).alias("high"),
        F.count_distinct(F.when(n >= 1, n)).alias("distinct"),
    )
    gap = F.coalesce(F.col("distinct") < F.col("high"), F.lit(False))
    null = F.col("filled") < F.col("rows")
    status = (
        F.when(gap & ~null, "Gap in sequence").when(null & ~gap, "Ends with NaN").otherwise("Complete sequence")
    )
    exact = (F.col("filled") == F.coalesce("high", F.lit(0))) & (F.col("distinct") == F.col("filled"))
    return sums.withColumns({"status": status, "exact": exact})


def duplicated_groups(df: DataFrame, keys: list[str], distinct: str) -> DataFrame:
    """Rows of repeated keys with the group's size and distinct count of a column."""
    sizes = with_keys(df, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_size"), F.count_distinct(distinct).alias("group_distinct")
    )
    return df.join(sizes.where("group_size > 1"), keys)
