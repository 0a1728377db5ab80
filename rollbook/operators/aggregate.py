"""Aggregations. Null group keys are dropped unless stated otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.nulls import is_missing
from rollbook.functions.values import round_half_even
from rollbook.operators.columns import all_of
from rollbook.operators.quantiles import count_values, distribution

QUARTILES = {"25th": 0.25, "Median": 0.5, "75th": 0.75}


def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose group keys are all present."""
    return df.where(all_of(F.col(k).isNotNull() for k in keys)) if keys else df


def count_distinct_by(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    return with_keys(df, keys).groupBy(*keys).agg(F.count_distinct(F.col(column)).alias(name))


def count_by(df: DataFrame, keys: list[str], name: str = "n", column: str | None = None) -> DataFrame:
    """Rows per key, or non-null values of one column per key."""
    counted = F.count(F.col(column)) if column else F.count(F.lit(1))
    return with_keys(df, keys).groupBy(*keys).agg(counted.alias(name))


def sum_by(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return with_keys(df, keys).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def mean_std_by(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    return with_keys(df, keys).groupBy(*keys).agg(
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")
    )


def _summary(found: DataFrame, label: str | None, digits: int) -> DataFrame:
    names = {"mean": "Mean", "std": "Std", **{q: q for q in QUARTILES}}
    rounded = [round_half_even(F.col(f"`{c}`"), digits).alias(name) for c, name in names.items()]
    return found.select(*([label] if label else []), *rounded, F.col("n").alias("Count"))


def summary_stats(
    df: DataFrame, value: str, by: str | None = None, label: str | None = None, digits: int = 1
) -> DataFrame:
    """Mean, Std, quartiles and Count of a value, per group or overall."""
    if not by:
        return _summary(distribution(count_values(df, value, []), [], QUARTILES), None, digits)
    name = label or by
    counted = count_values(with_keys(df, [by]).withColumnRenamed(by, name), value, [name])
    return _summary(distribution(counted, [name], QUARTILES), name, digits)


def summary_stats_with_all(df: DataFrame, value: str, by: str, label: str, digits: int = 1) -> DataFrame:
    """The grouped summary with an ungrouped "All" row, from one pass over the rows."""
    counted = count_values(df.select(F.col(by).cast("string").alias(label), value), value, [label])
    overall = counted.groupBy("_v").agg(F.sum("_c").alias("_c")).select(F.lit("All").alias(label), "_v", "_c")
    both = counted.where(F.col(label).isNotNull()).unionByName(overall)
    return _summary(distribution(both, [label], QUARTILES), label, digits)


def unit_counts(df: DataFrame, unit: list[str], counted: str | None = None) -> DataFrame:
    """Rows (or non-null values) per unit, as column n."""
    return count_by(df, unit, "n", counted)


def two_level_stats(
    df: DataFrame,
    unit: str,
    by: str,
    counted: str | None = None,
    more_than: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Mean, std, quartiles and maximum of per-unit counts within each group.

    Distinct counts per group number at most the square root of its rows, so
    the exact percentile of (count, how often) pairs stays small.
    """
    per_unit = unit_counts(df, [by, unit], counted)
    if more_than is not None:
        per_unit = per_unit.where(F.col("n") > more_than)
    if at_most is not None:
        per_unit = per_unit.where(F.col("n") <= at_most)
    often = per_unit.groupBy(by, "n").agg(F.count(F.lit(1)).alias("units"))
    stats = per_unit.groupBy(by).agg(
        F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"), F.max("n").alias("max"),
        F.count(F.lit(1)).alias("units"),
    )
    middle = often.groupBy(by).agg(
        *[
            F.percentile("n", F.lit(p), F.col("units")).alias(name)
            for name, p in {"p25": 0.25, "p50": 0.5, "p75": 0.75}.items()
        ]
    )
    return stats.join(middle, by)


def count_frequency(df: DataFrame, unit: list[str], counted: str | None = None) -> DataFrame:
    """How many units have each count."""
    return unit_counts(df, unit, counted).groupBy("n").agg(F.count(F.lit(1)).alias("units"))


def bin_label(col: Column, edges: list[float], labels: list[str], include_lowest: bool = True) -> Column:
    """Label of the right-closed range (edges[i], edges[i+1]]; null outside.

    The lowest edge belongs to the first range unless ``include_lowest`` is off.
    """
    out = None
    for i, name in enumerate(labels):
        low = col >= edges[i] if i == 0 and include_lowest else col > edges[i]
        test = low & (col <= edges[i + 1])
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def binned_counts(df: DataFrame, column: str, edges: list[float], labels: list[str], by: list[str] | None = None) -> DataFrame:
    keys = [*(by or []), "bin"]
    return count_by(df.withColumn("bin", bin_label(F.col(column), edges, labels)), keys)


def histogram(df: DataFrame, column: str, width: float, offset: float = 0.0, by: list[str] | None = None) -> DataFrame:
    """Counts in equal-width bins; ``bin`` is the lower edge."""
    lower = F.floor((F.col(column) - offset) / width) * width + offset
    return count_by(df.withColumn("bin", lower.cast("double")), [*(by or []), "bin"])


def centred_histogram(df: DataFrame, column: str, width: float, by: list[str] | None = None) -> DataFrame:
    """Counts in bins centred on multiples of the width; ``bin`` is the centre."""
    centre = F.floor(F.col(column) / width + 0.5) * width
    return count_by(df.withColumn("bin", centre.cast("double")), [*(by or []), "bin"])


def first_by(df: DataFrame, keys: list[str], column: str, order: list[str], name: str) -> DataFrame:
    """The column's value in the group's first row, by a stated order."""
    return with_keys(df, keys).groupBy(*keys).agg(
        F.min_by(column, F.struct(*order)).alias(name)
    )


def count_where(**conditions: Column) -> list[Column]:
    """One conditional row count per name, for use in a single ``agg``."""
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]


def distinct_where(column: str, **conditions: Column) -> list[Column]:
    """One conditional distinct count per name."""
    return [F.count_distinct(F.when(c, F.col(column))).alias(n) for n, c in conditions.items()]


def distinct_where_by(df: DataFrame, keys: list[str], column: str, every: str | None = None, **conditions: Column) -> DataFrame:
    """Distinct values per group under each condition, and under any row as ``every``, in one pass.

    Rows of a group and value become one with a mark for each condition, before and after they are shuffled, so the
    rows are read once and not copied for each condition. Groups in which no value meets a condition have 0.
    """
    marks = {name: F.coalesce(F.bool_or(c), F.lit(False)) for name, c in conditions.items()}
    held = with_keys(df, keys).groupBy(*keys, F.col(column).alias("_value")).agg(F.lit(1).alias("_one"), *[m.alias(f"_{n}") for n, m in marks.items()])
    present = F.col("_value").isNotNull()
    counts = [F.count_if(F.col(f"_{n}") & present).alias(n) for n in marks]
    return held.groupBy(*keys).agg(*counts, *([F.count_if(present).alias(every)] if every else []))


def any_by(df: DataFrame, keys: list[str], condition: Column, name: str) -> DataFrame:
    return with_keys(df, keys).groupBy(*keys).agg(
        F.coalesce(F.bool_or(condition), F.lit(False)).alias(name)
    )


def groups_where(df: DataFrame, keys: list[str], predicate: Column) -> DataFrame:
    """Keys of groups whose aggregate predicate holds."""
    return with_keys(df, keys).groupBy(*keys).agg(predicate.alias("_keep")).where("_keep").drop("_keep")


def value_counts(df: DataFrame, column: str, share: str | None = "pct") -> DataFrame:
    """Rows per value, null included, with its share in percent."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if not share:
        return counts
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn(share, F.col("n") / total * 100)


def _long(df: DataFrame, columns: list[str], to: str) -> DataFrame:
    typed = df.select(*[F.col(c).cast(to).alias(c) for c in columns])
    return typed.unpivot([], columns, "variable", "value")


def mode_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value of each column and its share of the non-null rows.

    Ties go to the smallest value.
    """
    counts = (
        _long(df, columns, "string").where(F.col("value").isNotNull())
        .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("a"), F.col("value").alias("b")))
    return counts.groupBy("variable").agg(best.alias("top"), F.sum("n").alias("total")).select(
        "variable", F.col("top.value").alias("mode"), F.col("top.n").alias("n"),
        (F.col("top.n") / F.col("total") * 100).alias("share"),
    )


def describe_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, std and quartiles of several numeric columns, one row each."""
    counted = count_values(_long(df, columns, "double"), "value", ["variable"])
    return distribution(counted, ["variable"], {"p25": 0.25, "p50": 0.5, "p75": 0.75})


def null_profile(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Null, blank and null-like counts of each column, in one pass over the rows."""
    keys = by or []
    measures = []
    for c in columns:
        text = F.col(c).cast("string")
        measures.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.count_if(F.trim(text) == "").alias("blanks"),
                F.count_if(is_missing(text)).alias("missing"),
                F.count(F.lit(1)).alias("rows"),
            )
        )
    wide = df.groupBy(*keys).agg(F.array(*measures).alias("_m"))
    return wide.select(*keys, F.inline("_m")).withColumn(
        "missing_pct", F.col("missing") / F.col("rows") * 100
    )


def multiplicity(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose value occurs once and rows whose value is repeated, per column."""
    counts = (
        _long(df, columns, "string").where(F.col("value").isNotNull())
        .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("variable").agg(
        F.sum(F.when(F.col("n") == 1, F.col("n")).otherwise(0)).alias("rows_once"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("rows_repeated"),
        F.count(F.lit(1)).alias("values"),
    )


def duplicate_values(df: DataFrame, columns: list[str], more_than: int = 1) -> DataFrame:
    return count_by(df, columns).where(F.col("n") > more_than)


def identifier_diagnostics(df: DataFrame, by: str, column: str, order: dict[str, int] | None = None) -> DataFrame:
    """Total, missing, unique and duplicate counts of an identifier per group.

    Blank ids are missing; duplicates are present rows beyond the distinct ids.
    """
    ident = F.nullif(F.trim(F.col(column)), F.lit(""))
    out = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ident.isNull()).alias("missing"),
        F.count_distinct(ident).alias("unique"),
        (F.count(ident) - F.count_distinct(ident)).alias("duplicates"),
    )
    if order:
        place = F.lit(len(order) + 1)
        for name, rank in order.items():
            place = F.when(F.col(by) == name, rank).otherwise(place)
        out = out.orderBy(place, by)
    return out


def one_to_one(df: DataFrame, a: str, b: str, by: str) -> DataFrame:
    """Per group: ids of each side, pairs that are one to one, ids with many partners.

    A partner count of 1 names its only partner, so the match is an equi join of
    two aggregates and no group is ever listed.
    """
    pairs = with_keys(df, [by, a, b]).select(by, a, b).distinct()

    def partners(side: str, other: str) -> DataFrame:
        return pairs.groupBy(by, side).agg(
            F.count(F.lit(1)).alias("k"), F.min(other).alias(other)
        )

    of_a, of_b = partners(a, b), partners(b, a)
    single = of_a.where("k = 1").drop("k").join(of_b.where("k = 1").drop("k"), [by, a, b])
    matched = single.groupBy(by).agg(F.count(F.lit(1)).alias("one_to_one"))

    def totals(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(by).agg(
            F.count(F.lit(1)).alias(f"{name}_ids"), F.count_if(F.col("k") > 1).alias(f"{name}_many")
        )

    return totals(of_a, a).join(totals(of_b, b), by).join(matched, by, "left").fillna(0, ["one_to_one"])


def groups_with_several(df: DataFrame, key: str, column: str, condition: Column) -> DataFrame:
    """Distinct values seen under a condition, per key."""
    return with_keys(df, [key]).groupBy(key).agg(
        F.count_distinct(F.when(condition, F.col(column))).alias("values")
    )


def with_total_row(df: DataFrame, label_column: str, label: str = "Total") -> DataFrame:
    """Append a row that sums every numeric column (sums, also of distinct counts).

    Each row counts once for itself and once for the total, so the frame is computed once. A frame without
    rows gives a total without numbers.
    """
    numbers = [c for c, t in df.dtypes if c != label_column and t in ("int", "bigint", "double")]
    itself = F.struct(F.monotonically_increasing_id().alias("row"), F.col(label_column).cast("string").alias("label"))
    whole = F.lit(None).cast("struct<row:bigint,label:string>")
    nothing = df.sparkSession.range(1).select(F.lit(None).cast("struct<row:bigint,label:string>").alias("_of"), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in numbers])
    twice = df.select(F.explode(F.array(itself, whole)).alias("_of"), *numbers).unionByName(nothing)
    summed = twice.groupBy("_of").agg(*[F.sum(c).alias(c) for c in numbers])
    named = F.when(F.col("_of").isNull(), F.lit(label)).otherwise(F.col("_of.label")).alias(label_column)
    return summed.select(named, *numbers).select(*[c for c in df.columns if c == label_column or c in numbers])


def repeat_entries(df: DataFrame, unit: str, year: str, by: str) -> DataFrame:
    """Per group, the years a unit appears beyond its first, summed."""
    years = with_keys(df, [by, unit]).groupBy(by, unit).agg(F.count_distinct(year).alias("years"))
    return years.groupBy(by).agg(F.sum(F.greatest(F.col("years") - 1, F.lit(0))).alias("repeats"))


def text_list(df: DataFrame, keys: list[str], name: str, value: str, out: str = "items") -> DataFrame:
    """ "name: value" entries of each group as one text, in name order.

    Meant for report tables: each entry is one row of an aggregated table.
    """
    entry = F.concat(F.col(name).cast("string"), F.lit(": "), F.col(value).cast("string"))
    return with_keys(df, keys).groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(entry)), ", ").alias(out)
    )


def share_of_total(df: DataFrame, value: str, by: list[str] | None = None, name: str = "share", scale: float = 1.0) -> DataFrame:
    """Value over the total of its group (or of all rows).

    The total is an aggregate joined back, so a large group is not gathered.
    """
    if by:
        total = with_keys(df, by).groupBy(*by).agg(F.sum(value).alias("_total"))
        return df.join(total, by, "left").withColumn(
            name, F.try_divide(F.col(value) * scale, F.col("_total"))
        ).drop("_total")
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value) * scale, total))


def lump_small(df: DataFrame, category: str, value: str, below_pct: float, other: str = "Other") -> DataFrame:
    """Sum categories whose share is below a threshold into one."""
    shared = share_of_total(df, value, None, "_share", 100.0)
    lumped = shared.withColumn(
        category, F.when(F.col("_share") < below_pct, other).otherwise(F.col(category))
    )
    return lumped.groupBy(category).agg(F.sum(value).alias(value))


def collapse_share(
    df: DataFrame, category: str, value: str, merge: dict[str, list[str]], exclude: list[str], by: list[str] | None = None
) -> DataFrame:
    """Merge listed categories, leave out others, then take shares in percent."""
    target = F.col(category)
    for name, members in merge.items():
        target = F.when(F.col(category).isin(members), name).otherwise(target)
    kept = df.where(~F.col(category).isin(exclude)) if exclude else df
    summed = sum_by(kept.withColumn(category, target), [*(by or []), category], [value])
    return share_of_total(summed, value, by, "share", 100.0)


def share_where(df: DataFrame, keys: list[str], condition: Column, name: str = "share") -> DataFrame:
    """Share of each group's rows that meet a condition, with the row count."""
    hit = F.count_if(F.coalesce(condition, F.lit(False)))
    return with_keys(df, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), (hit / F.count(F.lit(1))).alias(name)
    )


def mean_of_shares(df: DataFrame, unit: str, by: str, condition: Column) -> DataFrame:
    """Mean of the units' shares next to the share of the pooled rows."""
    hit = F.count_if(F.coalesce(condition, F.lit(False)))
    per_unit = with_keys(df, [by, unit]).groupBy(by, unit).agg(
        hit.alias("hits"), F.count(F.lit(1)).alias("n")
    )
    return per_unit.groupBy(by).agg(
        F.avg(F.col("hits") / F.col("n")).alias("mean_of_shares"),
        (F.sum("hits") / F.sum("n")).alias("share_of_total"),
    )


def flow_matrix(df: DataFrame, origin: str, target: str, counted: str | None = None) -> DataFrame:
    """Moves from origin to target, with the share of leavers and of receivers in percent."""
    measure = F.count_distinct(counted) if counted else F.count(F.lit(1))
    flows = with_keys(df, [origin, target]).groupBy(origin, target).agg(measure.alias("n"))
    leaving = share_of_total(flows, "n", [origin], "leavers_pct", 100.0)
    return share_of_total(leaving, "n", [target], "receivers_pct", 100.0)


def net_flow(df: DataFrame, origin: str, target: str) -> DataFrame:
    """Outgoing, incoming and net moves of each place (moves within are left out)."""
    moved = with_keys(df, [origin, target]).where(F.col(origin) != F.col(target))
    pairs = moved.groupBy(origin, target).agg(F.count(F.lit(1)).alias("n"))
    ends = F.explode(
        F.array(
            F.struct(F.col(origin).alias("place"), F.col("n").alias("outgoing"), F.lit(0).cast("long").alias("incoming")),
            F.struct(F.col(target).alias("place"), F.lit(0).cast("long").alias("outgoing"), F.col("n").alias("incoming")),
        )
    )
    sums = pairs.select(ends.alias("e")).groupBy("e.place").agg(
        F.sum("e.outgoing").alias("outgoing"), F.sum("e.incoming").alias("incoming")
    )
    net = F.col("outgoing") - F.col("incoming")
    sign = F.when(net > 0, "loses").when(net < 0, "gains").otherwise("even")
    return sums.withColumn("net", net).withColumn("direction", sign)


def funnel(stages: list[DataFrame], key: str, start: str, leaving: list[str], rest: str = "residual") -> DataFrame:
    """Stages side by side per key, and what remains of the first stage."""
    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), stages)
    numbers = [c for c in joined.columns if c != key]
    # Published counts may carry thousands separators.
    plain = [
        F.coalesce(F.regexp_replace(F.col(c).cast("string"), ",", "").try_cast("long"), F.lit(0)).alias(c)
        for c in numbers
    ]
    out = joined.select(key, *plain)
    return out.withColumn(rest, F.col(start) - reduce(lambda a, b: a + b, [F.col(c) for c in leaving]))


def load_report(df: DataFrame, expected: int | None = None) -> DataFrame:
    """Rows, fields and distinct rows of a load, next to the expected count."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("fields"),
        F.count_distinct(F.struct(*[F.col(c) for c in df.columns])).alias("distinct_rows"),
    ).withColumn("expected", F.lit(expected).cast("long"))
