"""Movement between districts, institute density, type and group shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollbook.functions.values import round_half_even
from rollbook.operators import aggregate as A, reshape as R
from rollbook.operators.joins import classify_in_base_year, per_capita, with_alias
from rollbook.operators.windows import top_overall_with_ties, top_rows

HOME, AWAY = "district", "institute_district"
# Bands of the female percentage in the base year.
FEMALE_BANDS = [(20, "Between 0 to 20"), (30, "Between 20 to 30"), (40, "Between 30 to 40"), (50, "Between 40 to 50")]
LAST_BAND = "Between 50 to 60"


def leavers(rows: DataFrame, home: str = HOME, away: str = AWAY) -> DataFrame:
    """Students per home place, those studying elsewhere and their percentage."""
    left = F.count_if(F.coalesce(F.col(home) != F.col(away), F.lit(False)))
    return A.with_keys(rows, [home]).groupBy(home).agg(
        F.count(F.lit(1)).alias("total_students"), left.alias("students_outside"),
        (left / F.count(F.lit(1)) * 100).alias("percentage_outside"),
    )


def top_leaving(rows: DataFrame, k: int = 10) -> DataFrame:
    """Places with the highest share of leavers, ties kept."""
    return top_overall_with_ties(leavers(rows), "percentage_outside", k)


def flows_from(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Where the students of the given home places study."""
    chosen = rows.join(places.select(HOME), HOME, "left_semi")
    return A.count_by(chosen, [HOME, AWAY], "n")


def incoming(rows: DataFrame) -> DataFrame:
    moved = rows.where(F.col(HOME) != F.col(AWAY))
    return A.count_by(moved, [AWAY], "total_incoming_students")


def migration(rows: DataFrame) -> DataFrame:
    return A.net_flow(rows, HOME, AWAY)


def institutes_by_district(rows: DataFrame) -> DataFrame:
    """Institutes per district and type, with their sum."""
    table = R.pivot_distinct(rows, [AWAY], "type_of_institute", "reported_institute", ["Govt.", "Pvt."])
    return table.withColumn("total_itis", F.col("`Govt.`") + F.col("`Pvt.`"))


def institutes_per_capita(rows: DataFrame, population: DataFrame, aliases: DataFrame) -> DataFrame:
    """Institutes per million people, district names brought to one spelling."""
    counts = with_alias(institutes_by_district(rows).withColumnRenamed(AWAY, HOME), HOME, aliases)
    rate = per_capita(counts, population, [HOME], "total_itis")
    return rate.withColumn("per_capita", round_half_even(F.col("per_capita"), 1))


def type_shares(rows: DataFrame) -> DataFrame:
    """Students per year by institute type with percentages to two decimals."""
    pvt, gov = F.col("type_of_institute") == "Pvt.", F.col("type_of_institute") == "Govt."
    sums = rows.groupBy("academic_year").agg(
        F.count(F.lit(1)).alias("total_students"), *A.count_where(pvt_students=pvt, gov_students=gov)
    )
    pct = lambda c: F.round(F.col(c) / F.col("total_students") * 100, 2)
    return sums.withColumns({"share_of_pvt": pct("pvt_students"), "share_of_gov": pct("gov_students")})


def institute_counts(rows: DataFrame) -> DataFrame:
    """Distinct institutes per year, overall and by type."""
    gov, pvt = F.col("type_of_institute") == "Govt.", F.col("type_of_institute") == "Pvt."
    return rows.groupBy("academic_year").agg(
        F.count_distinct("reported_institute").alias("total_institutes"),
        *A.distinct_where("reported_institute", gov_institutes=gov, pvt_institutes=pvt),
    )


def female_counts(rows: DataFrame, by: list[str], digits: int | None = 1) -> DataFrame:
    """Students, women and men per group and the female percentage."""
    sums = A.with_keys(rows, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_students"),
        *A.count_where(female_students=F.col("gender") == "Female", male_students=F.col("gender") == "Male"),
    )
    share = F.col("female_students") / F.col("total_students") * 100
    return sums.withColumn("female_percentage", share if digits is None else F.round(share, digits))


def female_bands(rows: DataFrame, base_year: int = 2023) -> DataFrame:
    """Institutes per year with the band of their female share in the base year.

    A share of 0 is outside all bands.
    """
    yearly = female_counts(rows, ["reported_institute", "academic_year"], None)
    banded = classify_in_base_year(
        yearly.where(F.col("female_percentage") > 0), "reported_institute", "academic_year", base_year,
        "female_percentage", FEMALE_BANDS, LAST_BAND,
    ).select("reported_institute", "band").distinct()
    return yearly.join(banded.where(F.col("band").isNotNull()), "reported_institute", "left")


def band_counts(rows: DataFrame, base_year: int = 2023) -> DataFrame:
    """Institutes per year and base-year band."""
    return A.count_by(female_bands(rows, base_year), ["academic_year", "band"], "institutes")


def largest_over_time(rows: DataFrame, base_year: int = 2023, k: int = 5) -> DataFrame:
    """The female share over time of the institutes that were largest in the base year."""
    yearly = female_counts(rows, ["reported_institute", "academic_year"], None)
    base = yearly.where(F.col("academic_year") == base_year)
    best = top_overall_with_ties(base, "total_students", k)
    return yearly.join(best.select("reported_institute"), "reported_institute", "left_semi")


def mean_female_share(rows: DataFrame) -> DataFrame:
    """Mean of the institutes' female shares against the share of all students, by year and type."""
    per_unit = female_counts(rows, ["academic_year", "type_of_institute", "reported_institute"], None)
    return per_unit.groupBy("academic_year", "type_of_institute").agg(
        F.avg("female_percentage").alias("mean_female_share"),
        (F.sum("female_students") / F.sum("total_students") * 100).alias("aggr_female_share"),
    )


def group_shares(rows: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Students per class, null included, with percentages overall or within groups."""
    counts = rows.groupBy(*(by or []), column).agg(F.count(F.lit(1)).alias("count"))
    shared = A.share_of_total(counts, "count", by, "Percentage", 100.0)
    return shared.withColumn("Percentage", F.round("Percentage", 1))


def income_shares(rows: DataFrame, merge: dict[str, list[str]], exclude: list[str], by: list[str] | None = None) -> DataFrame:
    counts = A.count_by(rows, [*(by or []), "annual_income"], "count")
    shared = A.collapse_share(counts, "annual_income", "count", merge, exclude, by)
    return shared.withColumn("share", F.round("share", 1))


def top_trades_with_ties(rows: DataFrame, by: str = "gender", k: int = 10) -> DataFrame:
    """Most chosen trades per group; equal counts at the edge are all kept."""
    counts = A.count_by(rows, [by, "reported_branch_or_trade", "course_period"], "student_count")
    return top_rows(counts, [by], [F.desc("student_count")], k, ties=True)


def trade_matrix(rows: DataFrame, trades: list[str]) -> DataFrame:
    """Students of each institute in the chosen trades."""
    return R.pivot_count(rows, ["reported_institute"], "reported_branch_or_trade", trades)


def core_trade_shares(rows: DataFrame, trades: list[str]) -> DataFrame:
    """Women in the core trades per year and institute type, in percent."""
    core = rows.where(F.col("reported_branch_or_trade").isin(trades))
    return female_counts(core, ["academic_year", "type_of_institute"])


def mean_marks(rows: DataFrame, by: list[str], value: str = "percentage") -> DataFrame:
    return A.with_keys(rows, by).groupBy(*by).agg(F.avg(value).alias("mean_marks"), F.count(value).alias("n"))
