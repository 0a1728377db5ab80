"""Exact quantiles and moments that never hold a group in one task.

Equal values are counted first, in the only pass over the rows. Values then
fall into buckets by order of magnitude. Bucket counts tell which buckets hold
the wanted ranks, and only the values of those are ordered; a bucket of many
values is first cut into finer ones in the same way. A group has at most some
millions of buckets, a bucket about a million finer ones, and a finer one some
millions of values, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Buckets per doubling of the value, finer ones per bucket, and a shift that
# keeps bucket numbers of positive values above zero down to the smallest double.
PER_DOUBLING = 1024
FINER = 1 << 20
SHIFT = 1100
# Values of a bucket that are ordered as they are.
MANY = 200_000
# Buckets of infinite and of missing values.
INFINITE = 4000 * PER_DOUBLING
NO_VALUE = -(1 << 62)


def count_values(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """How often each value occurs per group; nulls, and NaN as null, are counted as well."""
    v = F.col(value).cast("double")
    return df.groupBy(*by, F.nanvl(v, F.lit(None).cast("double")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))


def _scale(v: Column) -> Column:
    """A finite number that never falls as the value rises: exponent plus mantissa, in buckets."""
    size = F.abs(v)
    power = F.floor(F.log2(size))
    place = (power + size / F.pow(F.lit(2.0), power) - 1 + SHIFT) * PER_DOUBLING
    return (
        F.when(v == 0, 0.0).when(size == float("inf"), F.signum(v) * INFINITE).otherwise(F.signum(v) * place)
    )


def _bucket(v: Column) -> Column:
    return F.coalesce(F.floor(_scale(v)), F.lit(NO_VALUE).cast("long"))


def _finer(v: Column) -> Column:
    scaled = _scale(v)
    return F.coalesce(F.floor((scaled - F.floor(scaled)) * FINER), F.lit(0).cast("long"))


def _near(b: Column) -> Column:
    """A value close to all values of a bucket, to subtract before squaring."""
    place = F.abs(b) / PER_DOUBLING - SHIFT
    size = F.pow(F.lit(2.0), F.floor(place)) * (1 + place - F.floor(place))
    none = (b == 0) | (b == NO_VALUE) | (F.abs(b) >= INFINITE)
    return F.when(none, 0.0).otherwise(F.signum(b.cast("double")) * size)


def distribution(counted: DataFrame, by: list[str], probs: dict[str, float], many: int = MANY) -> DataFrame:
    """Per group of counted values: ``n``, ``mean``, ``std`` and a column per probability.

    Quantiles interpolate linearly between the two nearest ranks. Groups
    without any value keep a row with ``n`` 0. Only buckets of more than ``many`` values are cut finer.
    """
    placed = counted.withColumn("_b", _bucket(F.col("_v")))
    near = _near(F.col("_b"))
    # Within a bucket values are measured by how far they are from the near one, in its own size: no square overflows.
    unit = F.when(near == 0, 1.0).otherwise(near)
    off = (F.col("_v") - near) / unit
    some = F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0)
    sizes = placed.groupBy(*by, "_b").agg(
        F.sum(some).alias("_bc"), F.sum(off * F.col("_c")).alias("_s1"), F.sum(off * off * F.col("_c")).alias("_s2"), F.count(F.lit(1)).alias("_values")
    )
    # A group has at most one row per bucket here, however many rows it had.
    in_order = Window.partitionBy(*by).orderBy("_b")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = sizes.withColumn("_g", F.coalesce(F.nullif(F.max(F.abs(near)).over(whole), F.lit(0.0)), F.lit(1.0)))
    local_mean = near / F.col("_g") + unit / F.col("_g") * F.try_divide(F.col("_s1"), F.col("_bc"))
    starts = sizes.withColumns(
        {
            "_start": F.sum("_bc").over(in_order) - F.col("_bc"),
            "_n": F.sum("_bc").over(whole),
            "_mean": F.try_divide(F.sum(F.col("_bc") * local_mean).over(whole), F.sum("_bc").over(whole)),
        }
    )
    within = (F.col("_s2") - F.try_divide(F.pow("_s1", F.lit(2)), F.col("_bc"))) * F.pow(unit / F.col("_g"), 2)
    between = F.col("_bc") * F.pow(local_mean - F.col("_mean"), 2)
    starts = starts.withColumn("_dev", F.sum(F.greatest(within, F.lit(0.0)) + between).over(whole))

    place = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, p in probs.items()}
    ranks = F.array(*[rank for at in place.values() for rank in (F.floor(at), F.ceil(at))])
    holds = F.exists(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_bc")))
    wanted = starts.where(holds | (F.col("_n") == 0)).select(
        *by, "_b", "_start", "_n", (F.col("_mean") * F.col("_g")).alias("_mean"), "_dev", "_g", "_values"
    )
    few = placed.join(wanted.where(F.col("_values") <= many).drop("_values"), [*by, "_b"]).withColumn("_f", F.lit(-1).cast("long"))

    # The same once more inside the wanted buckets that hold many values.
    dense = wanted.where(F.col("_values") > many).drop("_values")
    cut = placed.join(dense, [*by, "_b"]).withColumn("_f", _finer(F.col("_v")))
    shared = ["_start", "_n", "_mean", "_dev", "_g"]
    finer = cut.groupBy(*by, "_b", "_f").agg(F.sum(some).alias("_fc"), *[F.first(c).alias(c) for c in shared])
    rising = Window.partitionBy(*by, "_b").orderBy("_f")
    begun = finer.withColumn("_start", F.col("_start") + F.sum("_fc").over(rising) - F.col("_fc"))
    holds = F.exists(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_fc")))
    chosen = begun.where(holds | (F.col("_n") == 0)).drop("_fc")
    rest = cut.drop(*shared).join(chosen, [*by, "_b", "_f"])

    ordered = Window.partitionBy(*by, "_b", "_f").orderBy("_v")
    fine = few.unionByName(rest).withColumn("_last", F.col("_start") + F.sum("_c").over(ordered))

    def at_rank(rank: Column) -> Column:
        inside = (rank >= F.col("_last") - F.col("_c")) & (rank < F.col("_last"))
        return F.max(F.when(inside, F.col("_v")))

    ends = {
        name: (at_rank(F.floor(at)), at_rank(F.ceil(at)), F.max(at - F.floor(at))) for name, at in place.items()
    }
    picked = fine.groupBy(*by).agg(
        F.coalesce(F.max("_n"), F.lit(0)).alias("n"), F.max("_mean").alias("mean"),
        F.max(F.sqrt(F.try_divide(F.col("_dev"), F.col("_n") - 1)) * F.col("_g")).alias("std"),
        *[c.alias(f"{name}_{i}") for name, cs in ends.items() for i, c in enumerate(cs)],
    )
    def blend(p: str) -> Column:
        low, high, part = F.col(f"`{p}_0`"), F.col(f"`{p}_1`"), F.col(f"`{p}_2`")
        # Equal ends may be infinite.
        return F.when(low == high, low).otherwise(low + (high - low) * part).alias(p)

    return picked.select(*by, "n", "mean", "std", *[blend(p) for p in probs])


def quantiles(df: DataFrame, value: str, by: list[str], probs: dict[str, float]) -> DataFrame:
    """One row per group with a column per named probability; null keys are dropped."""
    present = df
    for key in by:
        present = present.where(F.col(key).isNotNull())
    return distribution(count_values(present, value, by), by, probs).select(*by, *[F.col(f"`{p}`") for p in probs])
