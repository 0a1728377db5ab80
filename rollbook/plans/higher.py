"""Higher-secondary (HSS) and degree (DEG) datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions import categories as C, payload as P, text as X, values as V
from rollbook.functions.nulls import clean_strings, null_school, null_tokens, real_id
from rollbook.operators.columns import drop_empty_columns, keep_existing, order_columns
from rollbook.operators.payloads import explode_records

# Fields of one option and of one compartment subject.
HSS_OPTION_FIELDS = [
    "OptionNo", "Year", "Phase", "SAMSCode", "ReportedInstitute", "Stream", "InstituteDistrict",
    "InstituteBlock", "TypeofInstitute", "AdmissionStatus",
]
DEG_OPTION_FIELDS = [
    "OptionNo", "Year", "Phase", "SAMSCode", "ReportedInstitute", "Stream", "Subject", "InstituteDistrict",
    "InstituteBlock", "TypeofInstitute", "AdmissionStatus",
]
SUBJECT_FIELDS = ["COMPSubject", "COMPFailMark", "COMPPassMark"]
# Columns of the HSS enrolments and of the mark datasets, in order.
HSS_COLUMNS = [
    "barcode", "aadhar_no", "academic_year", "module", "gender", "dob", "social_category", "orphan",
    "es", "ph", "state", "district", "address", "block", "pin_code", "annual_income", "roll_no",
    "highest_qualification", "board_exam_name_for_highest_qualification",
    "examination_board_of_the_highest_qualification", "examination_type", "year_of_passing",
    "total_marks", "secured_marks", "percentage", "compartmental_status", "hss_option_details",
    "hss_compartments",
]
HSS_MARK_COLUMNS = [
    "barcode", "aadhar_no", "academic_year", "module", "board_exam_name_for_highest_qualification",
    "highest_qualification", "examination_board_of_the_highest_qualification", "examination_type",
    "year_of_passing", "total_marks", "secured_marks", "percentage", "compartmental_status",
]
DEG_MARK_COLUMNS = [
    "barcode", "aadhar_no", "board_exam_name_for_highest_qualification", "highest_qualification",
    "module", "academic_year", "examination_board_of_the_highest_qualification", "examination_type",
    "year_of_passing", "total_marks", "secured_marks", "percentage", "compartmental_status",
]
DEG_OPTION_ORDER = [
    "barcode", "aadhar_no", "academic_year", "year", "phase", "reported_institute", "sams_code",
    "institute_district", "institute_block", "type_of_institute", "stream", "subject", "option_no",
    "admission_status", "num_applications",
]
# yes/no columns, and columns and fields that the datasets leave out.
HSS_FLAGS = ["ph", "es", "sports", "national_cadet_corps", "orphan", "compartmental_status"]
DEG_FLAGS = ["es", "national_cadet_corps", "orphan", "ph", "sports"]
DEG_DROPPED = ["student_name", "nationality", "contact_no", "national_cadet_corps", "year"]
FIRST_CHOICE_DROPPED = ["ReportedInstitute", "InstituteBlock", "TypeofInstitute", "Year"]


def _known(df: DataFrame, rules: dict[str, Column]) -> dict[str, Column]:
    return {c: rule for c, rule in rules.items() if c in df.columns}


def hss_enrollments(df: DataFrame, sort: bool = False) -> DataFrame:
    """HSS rows with the enrolment columns, values as they arrive."""
    out = keep_existing(df.where(F.col("module") == "HSS"), HSS_COLUMNS)
    keys = [c for c in ["aadhar_no", "academic_year"] if c in out.columns]
    return out.orderBy(*keys) if sort and len(keys) == 2 else out


def hss_clean(df: DataFrame) -> DataFrame:
    """Typed HSS columns and a full address; flags in any case."""
    clean = clean_strings(df, null_school)
    rules = {
        "dob": V.to_timestamp_or_null(F.col("dob")),
        "percentage": V.percentage_in_range(F.col("percentage")),
        "year_of_passing": V.passing_year(F.col("year_of_passing")),
        "secured_marks": V.number(F.col("secured_marks")),
        "total_marks": V.number(F.col("total_marks")),
        "annual_income": F.trim(F.col("annual_income")),
        **{c: V.yes_no_any_case(F.col(c)) for c in HSS_FLAGS},
    }
    out = clean.withColumns(_known(df, rules))
    parts = ["address", "block", "district", "state", "pin_code"]
    if all(c in df.columns for c in parts):
        out = out.withColumn("full_address", X.address_line(*[F.col(c) for c in parts]))
    return out


def hss_applications(df: DataFrame, rename=lambda f: f) -> DataFrame:
    """One row per option; students without options keep one row."""
    return explode_records(df, "hss_option_details", HSS_OPTION_FIELDS, ["barcode", "academic_year"], rename)


def hss_applications_enriched(df: DataFrame) -> DataFrame:
    """Options under stored names, with the person and the number of options."""
    options = P.json_records(F.col("hss_option_details"), HSS_OPTION_FIELDS)
    counted = df.withColumn("num_applications", P.list_size(F.filter(options, lambda o: o["OptionNo"].isNotNull())))
    return explode_records(
        counted, "hss_option_details", HSS_OPTION_FIELDS, ["barcode", "aadhar_no", "academic_year", "num_applications"]
    )


def hss_compartments(df: DataFrame, rename=lambda f: f) -> DataFrame:
    """One row per failed subject; students without any keep one row."""
    return explode_records(df, "hss_compartments", SUBJECT_FIELDS, ["barcode", "academic_year"], rename)


def _marks(df: DataFrame, column: str, context: list[str]) -> DataFrame:
    keep = [c for c in context if c in df.columns]
    return explode_records(df.where(F.col(column).isNotNull()), column, SUBJECT_FIELDS, keep)


def hss_marks(df: DataFrame) -> DataFrame:
    """Marks of the last examination, one row per compartment subject."""
    return _marks(df, "hss_compartments", HSS_MARK_COLUMNS)


def deg_marks(df: DataFrame) -> DataFrame:
    return _marks(df, "deg_compartments", DEG_MARK_COLUMNS)


def first_choice_admissions(options: DataFrame) -> DataFrame:
    """Options numbered 1 whose status is ADMITTED."""
    first = F.trim(F.col("OptionNo").cast("string")) == "1"
    admitted = F.upper(F.trim(F.col("AdmissionStatus"))) == "ADMITTED"
    return order_columns(options.where(first & admitted).drop(*FIRST_CHOICE_DROPPED), ["barcode", "academic_year"])


def priority_admission(df: DataFrame) -> DataFrame:
    """The most telling option of each student, nulls when none is listed."""
    options = P.json_records(F.col("hss_option_details"), HSS_OPTION_FIELDS)
    best = P.preferred_record(options, "AdmissionStatus", C.OPTION_PREFERENCE)
    return df.select(best.alias("_b"), "barcode").select(
        *[F.col("_b").getField(f).alias(f) for f in HSS_OPTION_FIELDS], "barcode"
    )


def stream_trends(df: DataFrame) -> DataFrame:
    """Listed options per year and stream."""
    rows = explode_records(
        df, "hss_option_details", ["Year", "Stream"], ["barcode"], lambda f: f, keep_empty=False
    )
    counts = rows.where(F.col("Year").isNotNull() & F.col("Stream").isNotNull()).groupBy("Year", "Stream").agg(
        F.count(F.lit(1)).alias("student_count")
    )
    return counts.orderBy("Year", F.desc("student_count"), "Stream")


def with_local_flag(df: DataFrame, home: str = "district", institute: str = "InstituteDistrict") -> DataFrame:
    """Whether home and institute districts agree, ignoring case and blanks."""
    for c in (home, institute):
        if c not in df.columns:
            raise ValueError(f"missing column {c}")
    return df.withColumn("local", C.same_place(F.col(home), F.col(institute), loose=True))


def deg_enrollments(df: DataFrame, drop_empty: bool = True, sort: bool = False) -> DataFrame:
    """Clean degree enrolments; columns without any value go, ``phase`` stays.

    Dropping empty columns is the one data-dependent step and runs an aggregate.
    """
    clean = clean_strings(df, null_tokens)
    rules = {
        "dob": V.to_date_day_first(F.col("dob"), allow_year_only=False),
        "address": X.tidy_address_or_parts(
            F.col("address"), [F.col(c) for c in ["block", "district", "state", "pin_code"] if c in df.columns]
        ),
        "highest_qualification": C.titled_qualification(F.col("highest_qualification")),
        "aadhar_no": real_id(F.col("aadhar_no")),
        **{c: V.yes_no_any_case(F.col(c)) for c in DEG_FLAGS},
    }
    out = clean.withColumns(_known(df, rules)).drop(*DEG_DROPPED)
    if drop_empty:
        out = drop_empty_columns(out, protect=["phase"])
    out = out.where(F.col("aadhar_no").isNotNull())
    return out.orderBy("aadhar_no", "academic_year") if sort else out


def deg_applications(df: DataFrame) -> DataFrame:
    """One row per option, with the number of options of the application and year.

    The number is summed over applications before they are unnested and joined
    back, so option rows are never shuffled.
    """
    filled = df.where(F.col("deg_option_details").isNotNull() & F.col("academic_year").isNotNull())
    options = P.json_records(F.col("deg_option_details"), ["OptionNo"])
    listed = P.list_size(F.filter(options, lambda o: o["OptionNo"].isNotNull()))
    totals = filled.groupBy("academic_year", "barcode").agg(F.sum(listed).cast("long").alias("num_applications"))
    numbered = filled.join(totals, ["academic_year", "barcode"], "left")
    rows = explode_records(
        numbered, "deg_option_details", DEG_OPTION_FIELDS, ["aadhar_no", "academic_year", "barcode", "num_applications"]
    )
    return order_columns(rows, DEG_OPTION_ORDER)
