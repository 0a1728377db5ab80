"""Joins. Sides are not hinted: sizes decide at run time whether one is broadcast; only a filter of bounded size always is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.operators.columns import all_of

#: Words of 64 bits in a filter of keys: 8 MB of bits, however many keys there are.
FILTER_WORDS = 1 << 20
FILTER_BITS = 3
#: Rows of the right side that a tile of a join holds, about, and tiles for each task.
TILE_ROWS = 1 << 15
TASK_TILES = 4


def lookup(df: DataFrame, table: DataFrame, keys: list[str] | str) -> DataFrame:
    """Left equi join to a lookup table."""
    return df.join(table, keys, "left")


def join_renamed(
    left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi join on differently named keys; both key sets are kept."""
    match = [
        left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in pairs.items()
    ]
    return left.join(right, all_of(match), how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join where null matches null; keys appear once."""
    other = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    match = all_of(left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys)
    joined = left.join(other, match, how)
    if how in ("left_semi", "left_anti"):
        return joined
    keyed = [F.coalesce(left[k], other[f"_r_{k}"]).alias(k) for k in keys]
    rest = [left[c] for c in left.columns if c not in keys]
    rest += [other[c] for c in right.columns if c not in keys]
    return joined.select(*keyed, *rest)


def outer_fill(frames: list[DataFrame], keys: list[str], fill=0) -> DataFrame:
    """Full outer join of several measures by key, gaps filled."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.join(frame, keys, "full_outer")
    gaps = [F.coalesce(F.col(f"`{c}`"), F.lit(fill)).alias(c) for c in out.columns if c not in keys]
    return out.select(*keys, *gaps)


def rows_of_groups(df: DataFrame, flagged: DataFrame, keys: list[str], keep: bool = True) -> DataFrame:
    """Full rows of the flagged groups (or of all others)."""
    return df.join(flagged.select(*keys), keys, "left_semi" if keep else "left_anti")


def _bits_of(key: Column) -> tuple[Column, Column]:
    """The word of a filter that a whole-number key falls into, and the bits it sets there."""
    h = F.xxhash64(key.cast("long"))
    place = lambda n: F.shiftrightunsigned(h, 40 + 6 * n).bitwiseAND(F.lit(63)).cast("int")
    bits = F.lit(0).cast("long")
    for n in range(FILTER_BITS):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place(n)))
    return h.bitwiseAND(F.lit(FILTER_WORDS - 1).cast("long")), bits


def perhaps_among(df: DataFrame, key: str, wanted: DataFrame, other: str) -> DataFrame:
    """The rows whose whole-number key is among those of ``wanted``, and a few others.

    It thins rows out before an exact join, without shuffling them: a Bloom filter of the keys is sent to all tasks.
    Its size is bounded, so of very many keys it lets more rows through, but it never drops one that is wanted.
    """
    word, bits = _bits_of(F.col(other))
    marked = wanted.select(word.alias("_word"), bits.alias("_set")).groupBy("_word").agg(F.bit_or("_set").alias("_set"))
    word, bits = _bits_of(F.col(key))
    held = (word == F.col("_word")) & (F.col("_set").bitwiseAND(bits) == bits)
    return df.join(F.broadcast(marked), held, "left_semi")


def join_in_tiles(left: DataFrame, right: DataFrame, key: str, other: str, tasks: int) -> DataFrame:
    """Inner equi join on a key of few values with so many rows on both sides that one task should not make all its pairs.

    The rows of a key are dealt into blocks on each side, whatever else they hold, and two blocks meet in a tile. A row
    is sent once for each block of the other side. The right side, of which a task holds a block, should be the smaller one.
    """
    counted = left.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).cast("double").alias("_l")).join(
        right.groupBy(F.col(other).alias("_key")).agg(F.count(F.lit(1)).cast("double").alias("_r")), "_key")
    pairs, across = F.col("_l") * F.col("_r"), F.ceil(F.max("_r") / TILE_ROWS)
    down = F.ceil(TASK_TILES * tasks * F.max(pairs) / F.sum(pairs) / across)
    shape = counted.agg(F.struct(down.alias("down"), across.alias("across"))).scalar()
    # The numbers of rows tell the blocks, so that rows that repeat are dealt out too.
    block = lambda blocks: F.pmod(F.xxhash64(F.monotonically_increasing_id()), blocks)
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    one = left.where(F.col(key).isNotNull()).withColumn("_i", block(shape["down"])).withColumn("_j", every(shape["across"]))
    two = right.where(F.col(other).isNotNull()).withColumn("_m", block(shape["across"])).withColumn("_n", every(shape["down"]))
    # The number of partitions is fixed, as pairs are many more than the rows by which Spark would merge partitions, and the
    # right side is sent before it is joined, so that its size with all copies decides whether it is broadcast.
    one, two = one.repartition(tasks, key, "_i", "_j"), two.repartition(tasks, other, "_n", "_m")
    return one.join(two, (F.col(key) == F.col(other)) & (F.col("_i") == F.col("_n")) & (F.col("_j") == F.col("_m"))).drop("_i", "_j", "_m", "_n")


def with_alias(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Replace a name by its canonical name from an (alias, canonical) table."""
    known = aliases.select(F.col("alias").alias(column), F.col("canonical").alias("_canonical"))
    return df.join(known, column, "left").withColumn(
        column, F.coalesce("_canonical", column)
    ).drop("_canonical")


def per_capita(counts: DataFrame, population: DataFrame, keys: list[str], measure: str, per: float = 1e6) -> DataFrame:
    """Count per head of population, times ``per``."""
    rate = F.try_divide(F.col(measure), F.col("population")) * per
    return counts.join(population, keys, "left").withColumn("per_capita", rate)


def classify_in_base_year(
    df: DataFrame, unit: str, year: str, base_year: int, measure: str, bands: list[tuple[float, str]], last: str
) -> DataFrame:
    """Class of each unit from its base-year measure, joined to all its years.

    ``bands`` holds (upper bound, label) in rising order; ``last`` labels the rest.
    """
    label: Column = F.lit(last)
    for bound, name in reversed(bands):
        label = F.when(F.col(measure) <= bound, name).otherwise(label)
    base = df.where(F.col(year) == base_year).select(unit, label.alias("band"))
    return df.join(base, unit, "left")
