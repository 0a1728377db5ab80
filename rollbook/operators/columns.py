"""Choosing columns and rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.nulls import is_missing
from rollbook.functions.text import snake_name


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def keep_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def order_columns(df: DataFrame, first: list[str]) -> DataFrame:
    """The preferred columns first, all others after them."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def rename_all(df: DataFrame, rename=snake_name) -> DataFrame:
    return df.toDF(*[rename(c) for c in df.columns])


def drop_empty_columns(df: DataFrame, protect: Iterable[str] = ()) -> DataFrame:
    """Drop columns that are null in every row (runs one aggregate pass)."""
    checked = [c for c in df.columns if c not in set(protect)]
    if not checked:
        return df
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in checked]).first()
    empty = {c for c in checked if not filled[c]}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in empty])


def conform(df: DataFrame, schema: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Rename, keep the schema's columns and add missing ones as null text."""
    named = df.withColumnsRenamed(renames or {})
    return named.select(
        *[F.col(c) if c in named.columns else F.lit(None).cast("string").alias(c) for c in schema]
    )


def any_null(columns: list[str]) -> Column:
    return any_of(F.col(c).isNull() for c in columns)


def none_null(columns: list[str]) -> Column:
    return all_of(F.col(c).isNotNull() for c in columns)


def lacks_required(columns: list[str]) -> Column:
    """True when a required field is null, blank or "NA"."""
    return any_of(is_missing(F.col(c).cast("string")) for c in columns)


def contains_any_case(col: Column, words: list[str]) -> Column:
    return col.rlike("(?i)" + "|".join(words))


def percentage_mismatch(
    stored: Column, secured: Column, total: Column, tolerance: float | None = None
) -> Column:
    """True when the stored percentage differs from the marks.

    Without a tolerance both sides are compared after rounding to 2 decimals.
    """
    computed = F.try_divide(secured, total) * 100
    if tolerance is None:
        return F.round(computed, 2) != F.round(stored, 2)
    return F.abs(computed - stored) > tolerance


def row_sample(df: DataFrame, fraction: float, seed: int = 42, by: list[str] | None = None) -> DataFrame:
    """A random part of the rows for inspection.

    With ``by`` a digest of those columns and the seed decides, so the same rows
    are taken whatever the partitions, and by any engine that has MD5.
    """
    if by is None:
        return df.sample(False, fraction, seed)
    digest = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in by], F.lit(str(seed))))
    return df.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < int(fraction * (1 << 32)))
