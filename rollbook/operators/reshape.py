"""Pivots, row percentages and wide-to-long."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.values import round_half_even
from rollbook.operators.aggregate import with_keys


def fill(df: DataFrame, keep: list[str], value=0) -> DataFrame:
    """A value for nulls in all columns but the kept ones; names may hold dots."""
    return df.select(
        *[
            F.col(f"`{c}`") if c in keep else F.coalesce(F.col(f"`{c}`"), F.lit(value)).alias(c)
            for c in df.columns
        ]
    )


# The column that gathers values outside a list, until totals are made.
REST = "_rest"


def pivot(
    df: DataFrame, index: list[str], column: str, measure: Column, values: list | None = None, empty=None, rest: bool = False
) -> DataFrame:
    """One column per value of ``column``; pass the values when the domain is fixed.

    Values outside the list have no column. With ``rest`` they are gathered in
    ``REST``, which ``with_row_total`` and ``row_percentages`` count and then drop.
    """
    if rest and values is not None:
        name = F.col(column).cast("string")
        listed = [str(v) for v in values]
        df = df.withColumn(column, F.when(name.isNull() | name.isin(listed), name).otherwise(REST))
        values = [*listed, REST]
    table = with_keys(df, [*index, column]).groupBy(*index).pivot(column, values).agg(measure)
    return table if empty is None else fill(table, index, empty)


def pivot_count(df, index, column, values=None, counted: str | None = None, rest: bool = False) -> DataFrame:
    measure = F.count(counted) if counted else F.count(F.lit(1))
    return pivot(df, index, column, measure, values, 0, rest)


def pivot_distinct(df, index, column, counted: str, values=None, rest: bool = False) -> DataFrame:
    return pivot(df, index, column, F.count_distinct(counted), values, 0, rest)


def pivot_mean(df, index, column, value: str, values=None, digits: int | None = 1) -> DataFrame:
    measure = F.avg(value)
    return pivot(df, index, column, measure if digits is None else round_half_even(measure, digits), values)


def pivot_sum(df, index, column, value: str, values=None, rest: bool = False) -> DataFrame:
    """Sums per cell; booleans count as 0 and 1."""
    kind = dict(df.dtypes)[value]
    measure = F.sum(F.col(value).cast("int") if kind == "boolean" else F.col(value))
    return pivot(df, index, column, measure, values, 0, rest)


def pivot_first(df, index, column, value: str, order: list[str], values=None) -> DataFrame:
    """Value of the first row per cell, by a stated order."""
    first = with_keys(df, [*index, column]).groupBy(*index, column).agg(
        F.min_by(value, F.struct(*order)).alias("_first")
    )
    # Each cell has one value by now; max only picks it up.
    return first.groupBy(*index).pivot(column, values).agg(F.max("_first"))


def pivot_measures(df, index, column, measures: dict[str, Column], values=None) -> DataFrame:
    """Several measures per value, named "<value>_<measure>"; missing cells are 0."""
    named = [m.alias(n) for n, m in measures.items()]
    table = with_keys(df, [*index, column]).groupBy(*index).pivot(column, values).agg(*named)
    return fill(table, index)


def dash_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns with "-" for 0, for published tables."""
    shown = {c: F.when(F.col(c) == 0, "-").otherwise(F.col(c).cast("string")) for c in columns}
    return df.withColumns(shown)


def row_sum(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in columns])


def with_row_total(df: DataFrame, index: list[str], first: bool = True, name: str = "Total") -> DataFrame:
    """Total over all columns but the index, placed first or last; ``REST`` counts and goes."""
    cells = [c for c in df.columns if c not in index]
    total = row_sum(cells).alias(name)
    body = [F.col(f"`{c}`") for c in cells if c != REST]
    keys = [F.col(c) for c in index]
    return df.select(*keys, total, *body) if first else df.select(*keys, *body, total)


def row_percentages(
    df: DataFrame,
    columns: list[str],
    total_label: str,
    labels: list[str],
    digits: list[int],
    drop: bool = True,
) -> DataFrame:
    """Each column as a percentage of the row's total; the total comes last, ``REST`` counts and goes."""
    if len(columns) != len(labels):
        raise ValueError("as many labels as columns are needed")
    total = row_sum([*columns, *[c for c in df.columns if c == REST]])
    shares = [
        round_half_even(F.try_divide(F.col(f"`{c}`"), total) * 100, d).alias(label)
        for c, label, d in zip(columns, labels, digits)
    ]
    kept = [F.col(f"`{c}`") for c in df.columns if c != REST and not (drop and c in columns)]
    return df.select(*kept, *shares, total.alias(total_label))


def wide_to_long(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, [F.col(f"`{c}`") for c in columns], name, value)
