"""Trainee admissions and examination results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.functions import text as X, values as V
from rollbook.operators.reshape import pivot_distinct, pivot_first, pivot_sum, with_row_total
from rollbook.sources.catalog import read_tagged_files

# Fixed patterns: the years written in the file names.
ADMITTED_TAGS = {"year": r"^[^_]*?(\d{4})(?:_.*|\..*)$"}
RESULT_TAGS = {"year": r"^[^_]*_(\d{4})", "exam_year": r"Year(\d)"}


def read_admitted(spark: SparkSession, glob: str) -> DataFrame:
    return read_tagged_files(spark, glob, ADMITTED_TAGS)


def read_results(spark: SparkSession, glob: str) -> DataFrame:
    return read_tagged_files(spark, glob, RESULT_TAGS)


def clean_admitted(df: DataFrame) -> DataFrame:
    """Trainees under stored names; 2018 trades get the scheme suffix of later years."""
    trade = F.col("Trade_Name").cast("string")
    return df.select(
        F.col("year"), X.strip_quote(F.col("Roll_Num")).alias("roll_num"), F.col("ITI_Code").alias("iti_code"),
        F.when(F.col("year") == 2018, F.concat(trade, F.lit(" (NSQF)"))).otherwise(trade).alias("trade"),
        F.col("Gender").alias("gender"),
    )


def clean_results(sheets: DataFrame, national: DataFrame | None = None) -> DataFrame:
    """Results per roll number, year and examination year."""
    out = sheets.select(
        X.strip_quote(F.col("`Roll No`")).alias("roll_num"),
        X.first_word_lower(F.col("`Overall Result`")).alias("overall_result"), "year", "exam_year",
    )
    if national is None:
        return out
    year = F.col("admission_year").cast("int")
    more = national.select(
        X.roll_tail(F.col("prnnumber")).alias("roll_num"), F.col("status").alias("overall_result"),
        year.alias("year"), F.when(year == 2022, 2).otherwise(1).alias("exam_year"),
    )
    return out.unionByName(more)


def combine(admitted: DataFrame, results: DataFrame) -> DataFrame:
    """Each trainee with the first- and second-year result.

    When a result repeats, the alphabetically first one is kept.
    """
    keys = ["year", "roll_num"]
    wide = pivot_first(results, keys, "exam_year", "overall_result", ["overall_result"], [1, 2])
    named = wide.withColumnsRenamed({"1": "overall_result_y1", "2": "overall_result_y2"})
    return admitted.join(named, keys, "left")


def with_outcome(combined: DataFrame, institutes: DataFrame, trades: DataFrame, compat: bool = False) -> DataFrame:
    """Adds institute type, course period, dropout, pass and retained flags.

    A trade with several periods takes the shortest; ``compat`` keeps one row per period.
    """
    types = institutes.select(F.col("ncvtmis_code").alias("iti_code"), "type_of_institute").distinct()
    pairs = trades.select(F.col("reported_branch_or_trade").alias("trade"), "course_period").distinct()
    periods = pairs if compat else pairs.groupBy("trade").agg(F.min("course_period").alias("course_period"))
    out = combined.join(types, "iti_code", "left").join(periods, "trade", "left")
    results = [F.col("overall_result_y1"), F.col("overall_result_y2"), F.col("course_period")]
    dropout = V.dropped_out(*results)
    return out.withColumns({"dropout": dropout, "retained": ~dropout, "passed": V.passed(*results)})


def trainee_table(df: DataFrame, measure: str, gender: str | None = None, kinds: list[str] | None = None) -> DataFrame:
    """Trainees per year and institute type, with the total first.

    ``measure`` is admitted, passed, dropout or retained.
    """
    rows = df.where(F.col("gender") == gender) if gender else df
    if measure == "passed":
        rows = rows.where("passed")
    if measure in ("admitted", "passed"):
        table = pivot_distinct(rows, ["year"], "type_of_institute", "roll_num", kinds, rest=True)
    else:
        table = pivot_sum(rows, ["year"], "type_of_institute", measure, kinds, rest=True)
    return with_row_total(table, ["year"])


def admitted_students(enrolled: DataFrame, gender: str | None = None, kinds: list[str] | None = None) -> DataFrame:
    """Enrolled persons per year after 2017 and institute type, with the total first."""
    rows = enrolled.where(F.col("gender") == gender) if gender else enrolled
    table = pivot_distinct(rows.where(F.col("year") > 2017), ["year"], "type_of_institute", "aadhar_no", kinds, rest=True)
    return with_row_total(table, ["year"])


def all_tables(enrolled: DataFrame, trainees: DataFrame, kinds: list[str] | None = None) -> dict[str, DataFrame]:
    """The thirteen trainee tables by name."""
    out = {
        "students_admitted": admitted_students(enrolled, None, kinds),
        "students_admitted_female": admitted_students(enrolled, "Female", kinds),
    }
    for measure, genders in {
        "admitted": [None, "Female", "Male"], "passed": [None, "Female"],
        "dropout": [None, "Female", "Male"], "retained": [None, "Female", "Male"],
    }.items():
        for gender in genders:
            name = f"trainees_{measure}" + (f"_{gender.lower()}" if gender else "")
            out[name] = trainee_table(trainees, measure, gender, kinds)
    return out
