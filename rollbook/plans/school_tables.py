"""Higher-secondary applications, compartments and results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollbook.functions import values as V
from rollbook.operators import aggregate as A, reshape as R
from rollbook.operators.windows import first_rows

# The brackets of the percentage table.
BRACKETS = [0, 20, 30, 50, 70, 100]
BRACKET_LABELS = ["<20%", "20-30%", "30–50%", "50–70%", ">70%"]
STATUS_COLUMNS = {
    "ADMITTED": "Admitted", "NOT SELECTED": "Not Selected",
    "SELECTED BUT NOT ADMITTED": "Selected, Not Admitted", "TC TAKEN": "TC Taken",
}


def applicants_and_applications(options: DataFrame) -> DataFrame:
    return A.with_keys(options, ["Year"]).groupBy("Year").agg(
        F.count_distinct("barcode").alias("applicants"), F.count("barcode").alias("applications")
    )


def first_choice_status(options: DataFrame) -> DataFrame:
    """Applicants of the first option and their statuses per year."""
    first = options.where(F.trim(F.col("OptionNo")) == "1")
    total = A.count_distinct_by(first, ["Year"], "barcode", "Applicants")
    table = R.pivot_distinct(first, ["Year"], "AdmissionStatus", "barcode", list(STATUS_COLUMNS))
    return total.join(table.withColumnsRenamed(STATUS_COLUMNS), "Year", "left").fillna(0)


def admitted_anywhere(options: DataFrame) -> DataFrame:
    """Applicants per year and those admitted under any option."""
    hit = F.coalesce(F.col("AdmissionStatus") == "ADMITTED", F.lit(False))
    flags = A.any_by(options, ["barcode", "Year"], hit, "admitted")
    return flags.groupBy("Year").agg(
        F.count(F.lit(1)).alias("No. of Students"), F.count_if("admitted").alias("Admitted Students")
    )


def compartments_by_year(rows: DataFrame) -> DataFrame:
    """Students and students with compartments per year, and the share in percent."""
    one = rows.groupBy("barcode").agg(
        F.min("academic_year").alias("academic_year"),
        F.min(F.when(F.col("compartmental_status") == "YES", F.col("academic_year"))).alias("_failed"),
    )
    total = A.count_by(one, ["academic_year"], "Applicant Count")
    failed = A.count_by(one, ["_failed"], "Compartment Count").withColumnRenamed("_failed", "academic_year")
    both = total.join(failed, "academic_year", "left").fillna(0)
    share = F.col("Compartment Count") / F.col("Applicant Count") * 100
    return both.withColumn("% with Compartments", V.round_half_even(share, 2))


def subjects_by_year(rows: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Students per compartment subject and year, with the row total last."""
    table = R.pivot_distinct(rows, ["comp_subject"], "academic_year", "barcode", years, rest=True)
    return R.with_row_total(table, ["comp_subject"], first=False, name="Total Count")


def subject_shares(rows: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Share of each subject among compartment cases; small shares become Other."""
    cases = rows.where(F.col("compartmental_status") == "YES").select("barcode", "comp_subject").distinct()
    counts = A.count_by(cases, ["comp_subject"], "n")
    shares = A.share_of_total(counts, "n", None, "share", 100.0).withColumn("share", V.round_half_even(F.col("share"), 1))
    small = F.when(F.col("share") < threshold, "Other").otherwise(F.col("comp_subject"))
    return shares.groupBy(small.alias("comp_subject")).agg(F.sum("share").alias("share")).where("share > 0")


def brackets(rows: DataFrame) -> DataFrame:
    """Students and compartment cases per bracket of percentage, each student once."""
    valid = rows.where(F.col("percentage").between(0, 100))
    one = first_rows(
        valid.select("barcode", "percentage", "compartmental_status"), ["barcode"], ["percentage", "compartmental_status"]
    )
    binned = one.withColumn("Percentage", A.bin_label(F.col("percentage"), BRACKETS, BRACKET_LABELS))
    return binned.groupBy("Percentage").agg(
        F.count("barcode").alias("Total_Students"),
        *A.count_where(With_Compartments=F.col("compartmental_status") == "YES"),
    )


def compartments_by(rows: DataFrame, column: str) -> DataFrame:
    """Students with compartments by board, examination type or district, with shares."""
    cases = rows.where(F.col("compartmental_status") == "YES")
    counts = A.count_distinct_by(cases, [column], "barcode", "students")
    return A.share_of_total(counts, "students", None, "share", 100.0)


def rule_violations(rows: DataFrame, pass_total: float = 197.0) -> DataFrame:
    """Marked as compartment although total or subject marks say otherwise."""
    expected = (F.col("secured_marks") >= pass_total) & (F.col("comp_fail_mark") < F.col("comp_pass_mark"))
    return rows.where((F.col("compartmental_status") == "YES") & ~F.coalesce(expected, F.lit(False)))


def admitted_without_institute(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("AdmissionStatus") == "ADMITTED") & F.col("ReportedInstitute").isNull())


def flagged_without_subjects(rows: DataFrame, subjects_size) -> DataFrame:
    return rows.where((F.col("compartmental_status") == "YES") & (subjects_size == 0))


def genders_by_year(rows: DataFrame) -> DataFrame:
    table = R.pivot_count(rows, ["academic_year"], "gender", ["Male", "Female", "Transgender"], rest=True)
    total = R.with_row_total(table, ["academic_year"])
    return total.withColumnsRenamed({"academic_year": "Year", "Transgender": "Trans"})


def results_by_gender(rows: DataFrame) -> DataFrame:
    """Passed and failed students per year, overall and per gender, in one pass."""
    status = {"Passed": "NO", "Failed": "YES"}
    cells = {n: F.col("compartmental_status") == s for n, s in status.items()}
    for gender, prefix in {"Male": "Male", "Female": "Female", "Transgender": "Trans"}.items():
        cells |= {f"{prefix}_{n}": (F.col("gender") == gender) & (F.col("compartmental_status") == s) for n, s in status.items()}
    known = rows.where(F.col("compartmental_status").isNotNull())
    return A.with_keys(known, ["academic_year"]).groupBy(F.col("academic_year").alias("Year")).agg(*A.count_where(**cells))


def results_overall(rows: DataFrame) -> DataFrame:
    return A.with_keys(rows, ["gender"]).groupBy("gender").agg(
        F.count(F.lit(1)).alias("Overall"),
        *A.count_where(Passed=F.col("compartmental_status") == "NO", Failed=F.col("compartmental_status") == "YES"),
    )


def low_performance(rows: DataFrame, below: float = 33.0) -> DataFrame:
    """Percent of students below a percentage, per year and gender."""
    hit = F.count_if(F.coalesce(F.col("percentage") < below, F.lit(False)))
    share = F.nullif(hit, F.lit(0)) / F.count(F.lit(1)) * 100
    return R.pivot(rows, ["academic_year"], "gender", share, ["Female", "Male"])


def category_results(rows: DataFrame) -> DataFrame:
    """Counts, pass and fail rates and mean percentage per social category."""
    tidy = rows.withColumn("social_category", F.upper(F.trim("social_category")))
    upper = F.upper("compartmental_status")
    sums = A.with_keys(tidy, ["social_category"]).groupBy("social_category").agg(
        F.count(F.lit(1)).alias("Total Count"),
        *A.count_where(Passed=upper == "NO", Failed=upper == "YES"), F.avg("percentage").alias("Avg %"),
    )
    shared = A.share_of_total(sums, "Total Count", None, "% of Total Students", 100.0)
    pct = lambda c: V.round_half_even(F.col(c) / F.col("Total Count") * 100, 2)
    return shared.withColumns(
        {
            "% of Total Students": V.round_half_even(F.col("% of Total Students"), 2),
            "Pass Rate (%)": pct("Passed"), "Fail Rate (%)": pct("Failed"),
        }
    )


def category_stats(rows: DataFrame) -> DataFrame:
    tidy = rows.withColumn("social_category", F.upper(F.trim("social_category")))
    stats = A.summary_stats(tidy, "percentage", "social_category", digits=2)
    ends = A.with_keys(tidy, ["social_category"]).groupBy("social_category").agg(
        F.min("percentage").alias("Min"), F.max("percentage").alias("Max")
    )
    return stats.join(ends, "social_category")
