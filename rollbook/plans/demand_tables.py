"""Options, demand and seats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions import values as V
from rollbook.functions.text import tidy_name
from rollbook.operators import aggregate as A, reshape as R
from rollbook.operators.columns import any_null, none_null
from rollbook.operators.joins import outer_fill
from rollbook.operators.sets import mix_by
from rollbook.operators.windows import change_on_previous, first_rows, sequence_class, top_overall


def first_choices(options: DataFrame, tie_break: list[str], year: str = "academic_year") -> DataFrame:
    """One first option per person and year, of the lowest application number."""
    first = options.where(F.col("option_no").try_cast("int") == 1)
    return first_rows(first, ["aadhar_no", year], ["barcode", *tie_break])


def applicants_by_year(first: DataFrame, unit: str, year: str = "academic_year", years: list[int] | None = None) -> DataFrame:
    """First-choice applicants of each trade or institute, one column per year, total first."""
    table = R.pivot_distinct(first, [unit], year, "aadhar_no", years, rest=True)
    return R.with_row_total(table, [unit], name="Applicants")


def seats_by_year(strength: DataFrame, unit: str, years: list[int] | None = None, compat: bool = False) -> DataFrame:
    """Seats of each unit, one column per year, total first.

    Only the ``Total`` category counts; ``compat`` adds up every category.
    """
    rows = strength if compat else strength.where(F.col("category") == "Total")
    table = R.pivot_sum(rows, [unit], "academic_year", "strength", years, rest=True)
    return R.with_row_total(table, [unit], name="Total Seats")


def same_names(df: DataFrame, column: str) -> DataFrame:
    """Names tidied and title-cased, so both sides of a join agree."""
    return df.withColumn(column, tidy_name(F.col(column), titled=True))


def seats_against_applicants(seats: DataFrame, applicants: DataFrame, unit: str) -> DataFrame:
    """Seats, applicants, what is left and the utilisation class."""
    joined = seats.select(unit, F.col("Total Seats").alias("seats")).join(
        applicants.select(unit, F.col("Applicants").alias("applicants")), unit
    )
    return joined.withColumns(
        {
            "available_seats": V.available_seats(F.col("seats"), F.col("applicants")),
            "utilisation": V.utilisation_class(F.col("applicants"), F.col("seats")),
        }
    )


def seats_against_applicants_by_year(seats: DataFrame, applicants: DataFrame, unit: str, years: list[int]) -> DataFrame:
    """The same per year, with shortfalls shown as 0."""
    s = seats.select(unit, F.col("Total Seats"), *[F.col(f"`{y}`").alias(f"{y}_seats") for y in years])
    a = applicants.select(unit, "Applicants", *[F.col(f"`{y}`").alias(f"{y}_applicants") for y in years])
    left = {
        f"{y}_available": V.available_seats(F.col(f"{y}_seats"), F.col(f"{y}_applicants"), clip=True) for y in years
    }
    joined = s.join(a, unit).withColumns(left)
    return joined.withColumn("Available Seats", V.available_seats(F.col("Total Seats"), F.col("Applicants"), clip=True))


def seats_against_demand(strength: DataFrame, first: DataFrame, keys: list[str]) -> DataFrame:
    """Seats and first-choice applicants per key (type and year, or district and type), all keys kept."""
    seats = A.sum_by(strength.where(F.col("category") == "Total"), keys, ["strength"]).withColumnRenamed("strength", "seats")
    wanted = A.count_distinct_by(first, keys, "aadhar_no", "applicants")
    both = outer_fill([seats, wanted], keys)
    return both.withColumn("available_seats", V.available_seats(F.col("seats"), F.col("applicants")))


def available_by_year_and_type(demand: DataFrame) -> DataFrame:
    """Available seats of government and private institutes per year."""
    table = R.pivot_sum(demand, ["academic_year"], "type_of_institute", "available_seats", ["Govt.", "Pvt."])
    return table.withColumnsRenamed({"Govt.": "Govt Available Seats", "Pvt.": "Private Available Seats"})


def overloaded(demand: DataFrame, unit: str, k: int = 10) -> DataFrame:
    """Units whose demand exceeds their seats most."""
    return top_overall(demand.where(F.col("available_seats") < 0), ["available_seats", unit], k)


def with_most_room(demand: DataFrame, unit: str, k: int = 10) -> DataFrame:
    return top_overall(demand.where(F.col("available_seats") > 0), [F.desc("available_seats"), unit], k)


def utilisation_lists(demand: DataFrame, unit: str) -> DataFrame:
    """Per utilisation class, the units with their available seats as one text."""
    return A.text_list(demand, ["utilisation"], unit, "available_seats", "details")


def seat_growth(strength: DataFrame) -> DataFrame:
    """Seats per type and year, with the change on the year before."""
    totals = A.sum_by(strength.where(F.col("category") == "Total"), ["type_of_institute", "academic_year"], ["strength"])
    return change_on_previous(totals, ["type_of_institute"], "academic_year", "strength")


def demand_frame(options: DataFrame) -> DataFrame:
    """Applications and enrolling institutes per trade, year and reported institute."""
    rows = A.with_keys(options, ["trade", "academic_year", "reported_institute"])
    return rows.groupBy("trade", "academic_year", "reported_institute").agg(
        F.count("aadhar_no").alias("application_count"), F.count_distinct("sams_code").alias("iti_enrollment")
    )


def applicants_by_mix(options: DataFrame, kind: str = "type_of_institute", name: str = "institute_name") -> DataFrame:
    """Applicants per year by the kinds of institute they listed."""
    mixes = mix_by(options, ["academic_year", "aadhar_no"], name, kind)
    return R.pivot_count(mixes, ["academic_year"], "mix", ["Govt", "Mix", "Pvt"])


def applications_by_year(options: DataFrame) -> DataFrame:
    """Applications, applicants and applications per applicant by year."""
    per_person = A.count_by(options, ["academic_year", "aadhar_no"], "n")
    return per_person.groupBy("academic_year").agg(
        F.sum("n").alias("applications"), F.count(F.lit(1)).alias("applicants"), F.avg("n").alias("average")
    )


def options_coverage(people: DataFrame, size: Column, by: list[str]) -> DataFrame:
    """Persons with and without options, counting each person once per group."""
    once = people.select(*by, "aadhar_no", size.alias("_size")).groupBy(*by, "aadhar_no").agg(F.max("_size").alias("_size"))
    return once.groupBy(*by).agg(
        F.count("aadhar_no").alias("total_students"),
        *A.count_where(with_options=F.col("_size") > 0, without_options=F.col("_size") == 0),
    )


def option_quality(options: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Option rows that are complete, have a gap, or report without applying, per group."""
    return A.with_keys(options, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *A.count_where(
            incomplete=any_null(columns),
            complete=none_null(columns),
            reported_not_applied=F.col("reported_institute").isNotNull() & F.col("institute_name").isNull(),
            applied_without_type=F.col("institute_name").isNotNull() & F.col("type_of_institute").isNull(),
        ),
    )


def trade_mismatch(options: DataFrame) -> DataFrame:
    """Applications whose reported trade is none of the listed ones."""
    reported = F.col("reported_branch_or_trade")
    hit = F.coalesce(F.bool_or(F.col("trade") == reported), F.lit(False))
    return options.groupBy("barcode").agg(hit.alias("_hit")).where(~F.col("_hit")).select("barcode")


def sequence_summary(options: DataFrame, keys: list[str]) -> DataFrame:
    """Applications per kind of option numbering."""
    return A.count_by(sequence_class(options, keys, "option_no"), ["status", "exact"])


def side_by_side(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Several per-key tables as one."""
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), frames)
