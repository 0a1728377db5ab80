"""Rows out of JSON payload columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions import payload as P
from rollbook.functions.text import snake_name


def explode_records(
    df: DataFrame,
    column: str,
    fields: list[str],
    keep: list[str],
    rename=snake_name,
    keep_empty: bool = True,
) -> DataFrame:
    """One row per list element, its fields as columns; narrow, without a shuffle.

    Null, unreadable and empty lists keep one row with null fields, unless
    ``keep_empty`` is off.
    """
    records = P.json_records(F.col(column), fields)
    unnest = F.explode_outer(records) if keep_empty else F.explode(records)
    rows = df.select(*keep, unnest.alias("_r"))
    return rows.select(*keep, *[F.col("_r").getField(f).alias(rename(f)) for f in fields])


def key_list(df: DataFrame, mapping: Column) -> DataFrame:
    """The distinct keys over all maps."""
    return df.select(F.explode(F.map_keys(mapping)).alias("_k")).distinct()


def _spread_keys(parsed: DataFrame, keep: list[str], name: str, value: str, skip: list[str], pieces: int | None) -> DataFrame:
    """One row per row and key of the union of all keys of the map ``_m``; absent keys give null.

    The key list is the payload's field list; it is found in the same plan, as
    a scalar subquery. Where keys are data and may be many, ``pieces`` deals
    the list out, and rows meet one piece after the other in a join.
    """
    keys = key_list(parsed, F.col("_m")).where(~F.col("_k").isin(skip) if skip else F.lit(True))
    if pieces is None:
        every = keys.agg(F.sort_array(F.collect_set("_k"))).scalar()
        rows = parsed.withColumn("_ks", every).withColumn(name, F.explode("_ks"))
    else:
        piece = F.pmod(F.xxhash64("_k"), F.lit(pieces))
        lists = keys.groupBy(piece.alias("_piece")).agg(F.collect_list("_k").alias("_ks"))
        spread = parsed.withColumn(
            "_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long")))
        )
        rows = spread.join(lists, "_piece").withColumn(name, F.explode("_ks"))
    return rows.select(*keep, name, F.try_element_at("_m", F.col(name)).alias(value))


def map_to_long(df: DataFrame, column: str, keep: list[str], name: str, value: str, pieces: int | None = None) -> DataFrame:
    """One JSON object per row to one row per row and key of any object."""
    parsed = df.select(*keep, P.json_object(F.col(column)).alias("_m"))
    return _spread_keys(parsed, keep, name, value, [], pieces)


def list_to_long(
    df: DataFrame, column: str, keep: list[str], stage_key: str, stage: str, name: str, value: str, pieces: int | None = None
) -> DataFrame:
    """Each element of a JSON list to one row per key of any element, the stage kept beside it."""
    rows = df.select(*keep, F.explode(P.json_maps(F.col(column))).alias("_m"))
    staged = rows.withColumn(stage, F.try_element_at("_m", F.lit(stage_key)))
    return _spread_keys(staged, [*keep, stage], name, value, [stage_key], pieces)


def option_sizes(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Applicants with and without list entries, and the entries, per group."""
    size = P.list_size(P.json_maps(F.col(column)))
    return df.groupBy(*by).agg(
        F.count_if(size > 0).alias("with_options"),
        F.count_if(size == 0).alias("without_options"),
        F.sum(size).cast("long").alias("options"),
    )
