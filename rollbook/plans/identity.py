"""Student identity across modules: common schema, keys and diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions import identity as I, payload as P
from rollbook.functions.categories import status_rank, STATUS_PRIORITY
from rollbook.functions.nulls import real_id
from rollbook.operators import aggregate as A
from rollbook.operators.columns import conform
from rollbook.operators.joins import outer_fill
from rollbook.operators.windows import duplicated_groups, first_rows

# The common schema, module renames and the keys read from marksheets.
COMMON_SCHEMA = [
    "sams_id", "academic_year", "barcode", "aadhar_no", "student_name", "dob", "passing_year",
    "roll_no", "examination_type", "exam_board", "admission_status",
]
HIGHER_RENAMES = {
    "id": "sams_id", "year_of_passing": "passing_year",
    "examination_board_of_the_highest_qualification": "exam_board",
}
MARKSHEET_KEYS = {
    "YearofPassing": "passing_year", "RollNo": "roll_no", "ExaminationType": "examination_type",
    "HighestQualificationExamBoard": "exam_board",
}
KEY_PARTS = ["student_name", "passing_year", "dob", "roll_no_decrypted", "exam_board", "examination_type"]
MODULE_ORDER = {"ITI": 1, "Diploma": 2, "HSS": 3, "DEG": 4}
OVERLAP_FLAGS = {"applied_iti": "ITI", "applied_diploma": "Diploma", "applied_hss": "HSS", "applied_degree": "DEG"}


def _identified(df: DataFrame) -> DataFrame:
    return df.withColumn("aadhar_no", real_id(F.col("aadhar_no")))


def marksheet_identity(df: DataFrame) -> DataFrame:
    """Common schema from the first marksheet (ITI, Diploma, PDIS)."""
    first = P.json_records(F.col("mark_data"), list(MARKSHEET_KEYS))
    fields = {stored: P.first_value(first, source) for source, stored in MARKSHEET_KEYS.items()}
    return _identified(conform(df.withColumns(fields), COMMON_SCHEMA, {"id": "sams_id"}))


def option_identity(df: DataFrame, option_column: str) -> DataFrame:
    """Common schema with the status taken from the option list (HSS, DEG)."""
    options = P.json_records(F.col(option_column), ["AdmissionStatus"])
    named = df.withColumn("admission_status", P.any_equal(options, "AdmissionStatus", "ADMITTED"))
    return _identified(conform(named, COMMON_SCHEMA, HIGHER_RENAMES))


def with_student_key(df: DataFrame, key: Column | str | None) -> DataFrame:
    """Decrypted and checked roll number, and the composite key.

    Without a key the roll number is taken as plain text.
    """
    roll = I.decrypt_roll(F.col("roll_no"), key) if key is not None else F.coalesce("roll_no", F.lit("NA"))
    out = df.withColumn("roll_no_original", roll).withColumn(
        "roll_no_decrypted", I.valid_roll(F.col("roll_no_original"), F.col("exam_board"))
    )
    return out.withColumn("student_key", I.student_key(*[F.col(c) for c in KEY_PARTS]))


def marksheet_keys(df: DataFrame) -> DataFrame:
    """One row per marksheet with the hyphen key; null when a part is missing."""
    rows = df.where(F.col("module").isin("ITI", "Diploma", "PDIS")).select(
        "module", "academic_year", "aadhar_no", "dob", "student_name",
        F.explode_outer(P.json_records(F.col("mark_data"), ["ExamName", *MARKSHEET_KEYS])).alias("_m"),
    )
    parts = rows.select(
        "module", "academic_year", "aadhar_no", "dob", "student_name",
        F.col("_m.ExamName").alias("exam_name"),
        F.col("_m.YearofPassing").try_cast("int").alias("passing_year"),
        F.col("_m.HighestQualificationExamBoard").alias("exam_board"),
        F.col("_m.ExaminationType").alias("exam_type"), F.col("_m.RollNo").alias("roll_no"),
    )
    order = ["student_name", "dob", "passing_year", "exam_board", "exam_type", "roll_no"]
    return parts.withColumn("unique_key", I.strict_student_key(*[F.col(c) for c in order]))


def module_overlap(keys: DataFrame, key: str = "unique_key", module: str = "module") -> DataFrame:
    """Which modules each key applied to, and how many."""
    flags = [
        F.max(F.when(F.col(module) == m, 1).otherwise(0)).alias(name) for name, m in OVERLAP_FLAGS.items()
    ]
    out = keys.groupBy(key).agg(*flags)
    total = sum((F.col(n) for n in OVERLAP_FLAGS), F.lit(0))
    return out.withColumn("total_applied", total)


def overlap_count(overlap: DataFrame, *flags: str) -> DataFrame:
    """Keys that have all the flags."""
    hit = F.lit(True)
    for f in flags:
        hit = hit & (F.col(f) == 1)
    return overlap.agg(F.count_if(hit).alias("keys"))


def admission_summary(options: DataFrame, person: str = "aadhar_no", year: str = "academic_year", status: str = "admission_status") -> DataFrame:
    """Applications and persons by their best status per year.

    The best rank per person and year is a plain maximum, so no rows are ranked.
    """
    total = A.count_by(options, [year], "applications")
    best = options.where(real_id(F.col(person)).isNotNull()).groupBy(year, person).agg(
        F.max(status_rank(F.col(status))).alias("_best")
    )
    names = {name.lower().replace(" ", "_"): rank for name, rank in STATUS_PRIORITY.items()}
    by_status = best.groupBy(year).agg(
        *A.count_where(**{n: F.col("_best") == r for n, r in names.items()}, unknown=F.col("_best") == 0)
    )
    return total.join(by_status, year, "left").fillna(0)


def application_status_by_year(people: DataFrame, applications: DataFrame, prefix: str) -> DataFrame:
    """Applications and persons admitted, with certificate taken and not admitted, per year."""
    first = people.where(real_id(F.col("aadhar_no")).isNotNull()).groupBy("academic_year", "aadhar_no").agg(
        F.min_by("admission_status", "barcode").alias("status")
    )
    text = F.col("status")
    persons = first.groupBy("academic_year").agg(
        F.count(F.lit(1)).alias(f"{prefix}_unique_applicant"),
        *A.count_where(
            **{
                f"{prefix}_admitted": text == "Yes",
                f"{prefix}_tc_taken": text.startswith("TC Taken"),
                f"{prefix}_not_admitted": text == "No",
            }
        ),
    )
    rows = A.count_by(applications, ["academic_year"], f"{prefix}_total_applications")
    return persons.join(rows, "academic_year", "left").fillna(0)


def status_table(iti: DataFrame, diploma: DataFrame) -> DataFrame:
    return outer_fill([iti, diploma], ["academic_year"])


def yearly_match(df: DataFrame, person: str = "aadhar_no", key: str = "student_key", year: str = "academic_year") -> DataFrame:
    """Persons, keys, one-to-one pairs and many-to-one ids per year."""
    admitted = df.groupBy(year).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.coalesce(F.lower("admission_status") == "yes", F.lit(False))).alias("total_admitted"),
    )
    return admitted.join(A.one_to_one(df, person, key, year), year, "left").fillna(0)


def missing_by_year(df: DataFrame, columns: list[str], totals: DataFrame | None = None) -> DataFrame:
    """Null, blank and NA values of each column per year, next to the year's row count."""
    measures = []
    for c in columns:
        text = F.col(c).cast("string")
        measures.append(F.count_if(text.isNull() | text.isin("", "NA", "na")).alias(c))
    counts = df.groupBy("academic_year").agg(F.count(F.lit(1)).alias("total"), *measures)
    if totals is None:
        return counts
    return totals.join(counts.drop("total"), "academic_year", "left")


def roll_coverage(df: DataFrame) -> DataFrame:
    """Rows with a usable roll number, and rows whose roll failed the check."""
    given = F.trim(F.coalesce("roll_no_original", F.lit(""))) != ""
    valid = F.col("roll_no_decrypted") != "NA"
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *A.count_where(rows_with_NA=given & ~valid, valid_rows=given & valid),
    )


def person_roll_coverage(df: DataFrame) -> DataFrame:
    """Persons with and without any usable roll number."""
    usable = F.bool_or(F.coalesce(F.col("roll_no_decrypted") != "NA", F.lit(False)))
    people = df.where(F.col("aadhar_no").isNotNull()).groupBy("aadhar_no").agg(
        usable.alias("has_roll"), F.count(F.lit(1)).alias("n")
    )
    return people.agg(
        F.count(F.lit(1)).alias("unique_aadhar"),
        *A.count_where(with_roll=F.col("has_roll"), without_roll=~F.col("has_roll")),
    )


def problematic_keys(df: DataFrame, key: str = "student_key", person: str = "aadhar_no") -> DataFrame:
    """Rows of keys that repeat and belong to several persons."""
    rows = duplicated_groups(df, [key], person)
    return rows.where("group_distinct > 1").withColumnsRenamed(
        {"group_size": "dup_count", "group_distinct": "unique_aadhar_count"}
    )


def person_diagnostics(students: DataFrame) -> DataFrame:
    """Total, missing, unique and duplicate person ids per module; the hash of "" is missing."""
    cleaned = students.where(F.col("module").isin(list(MODULE_ORDER))).withColumn(
        "aadhar_no", real_id(F.col("aadhar_no"))
    )
    return A.identifier_diagnostics(cleaned, "module", "aadhar_no", MODULE_ORDER)


def best_rows(options: DataFrame, person: str, year: str, status: str, tie_break: list[str]) -> DataFrame:
    """The most telling option row per person and year."""
    return first_rows(options, [year, person], [status_rank(F.col(status)).desc(), *tie_break])


def students_by_module(df: DataFrame, modules: list[str]) -> DataFrame:
    """Distinct persons per year and module, their sum and the overall distinct count."""
    ided = df.withColumn("_id", I.unified_person_id(F.col("module"), F.col("barcode"), real_id(F.col("aadhar_no"))))
    # One row per year and person, with a mark for each module: everything is counted from these.
    marks = {m: F.col("module") == m for m in modules} | {"Unique": F.col("module").isin(modules)}
    counted = A.distinct_where_by(ided, ["academic_year"], "_id", **marks)
    total = sum((F.col(m) for m in modules), F.lit(0))
    return counted.select("academic_year", *modules, total.alias("Total"), F.nullif("Unique", F.lit(0)).alias("Unique"))
