"""Raw records: normalising, appending without duplicates, tracking completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.functions.nulls import is_missing
from rollbook.operators.columns import all_of, any_of

# Source field names of a student record and the stored names.
STUDENT_FIELDS = {
    "Barcode": "barcode", "StudentName": "student_name", "Gender": "gender",
    "ReligionName": "religion_name", "DOB": "dob", "ContactNo": "contact_no",
    "AadharNo": "aadhar_no", "Nationality": "nationality", "AnnualIncome": "annual_income",
    "Address": "address", "State": "state", "District": "district", "Block": "block",
    "PINCode": "pin_code", "SocialCategory": "social_category", "Domicile": "domicile",
    "S_DomicileCategory": "s_domicile_category",
    "OutsideOdishaApplicantStateName": "outside_odisha_applicant_state_name",
    "OdiaApplicantLivingOutsideOdishaStateName": "odia_applicant_living_outside_odisha_state_name",
    "ResidenceBarcodeNumber": "residence_barcode_number",
    "TengthExamSchoolAddress": "tenth_exam_school_address",
    "EighthExamSchoolAddress": "eighth_exam_school_address",
    "HighestQualification": "highest_qualification",
    "HighestQualificationExamBoard": "highest_qualification_exam_board",
    "BoardExamNameforHighestQualification": "board_exam_name_for_highest_qualification",
    "ExaminationBoardoftheHighestQualification": "examination_board_of_the_highest_qualification",
    "ExaminationType": "examination_type", "YearofPassing": "year_of_passing", "RollNo": "roll_no",
    "TotalMarks": "total_marks", "SecuredMarks": "secured_marks", "Percentage": "percentage",
    "CompartmentalStatus": "compartmental_status",
    "hadTwoYearFullTimeWorkExpAfterTength": "had_two_year_full_time_work_exp_after_tenth",
    "GC": "gc", "PH": "ph", "ES": "es", "Sports": "sports",
    "NationalCadetCorps": "national_cadet_corps", "PMCare": "pm_care", "Orphan": "orphan",
    "IncomeBarcode": "income_barcode", "TFW": "tfw", "EWS": "ews", "BOC": "boc",
    "BOCRegdNo": "boc_regd_no", "CourseName": "course_name", "CoursePeriod": "course_period",
    "BeautyCultureType": "beauty_culture_type", "SAMSCode": "sams_code",
    "ReportedInstitute": "reported_institute", "ReportedBranchORTrade": "reported_branch_or_trade",
    "InstituteDistrict": "institute_district", "TypeofInstitute": "type_of_institute",
    "Phase": "phase", "Year": "year", "AdmissionStatus": "admission_status",
    "EnrollmentStatus": "enrollment_status", "AppliedStatus": "applied_status",
    "DateOfApplication": "date_of_application", "ApplicationStatus": "application_status",
    "RegistrationNumber": "registration_number", "MarkData": "mark_data",
    "OptionData": "option_data", "HssOptionDetails": "hss_option_details",
    "HSSOptionDetails": "hss_option_details", "hssCompartments": "hss_compartments",
    "HSSCompartments": "hss_compartments", "DEGOptionDetails": "deg_option_details",
    "DEGCompartments": "deg_compartments",
}
# Uniqueness and required columns of the two base tables.
STUDENT_KEY = [
    "barcode", "module", "academic_year", "applied_status", "enrollment_status",
    "admission_status", "phase", "year",
]
INSTITUTE_KEY = ["sams_code", "module", "academic_year", "trade", "branch", "admission_type"]
STUDENT_REQUIRED = ["barcode", "student_name", "year", "module", "academic_year"]
INSTITUTE_REQUIRED = ["sams_code", "academic_year", "module", "institute_name", "type_of_institute"]
# Modules and their first and last year.
MODULE_YEARS = {
    "ITI": (2017, 2024), "Diploma": (2018, 2024), "PDIS": (2020, 2024),
    "HSS": (2018, 2024), "DEG": (2018, 2024),
}
ZERO_YEAR_MODULES = ["HSS", "DEG"]


def _stored(pick, fields: dict[str, str], module: Column | str, academic_year: Column | int) -> list[Column]:
    """Stored columns from a function that gives a source field's column, or None."""
    sources: dict[str, list[Column]] = {stored: [] for stored in fields.values()}
    for source, stored in fields.items():
        found = pick(source)
        if found is not None:
            sources[stored].append(found)
    empty = F.lit(None).cast("string")
    out = {stored: F.coalesce(*found) if found else empty for stored, found in sources.items()}
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    if "year" in out:
        default = F.when(as_col(module).isin(ZERO_YEAR_MODULES), 0)
        out["year"] = F.coalesce(out["year"].try_cast("int"), default)
    out |= {"module": as_col(module), "academic_year": as_col(academic_year).cast("int")}
    return [c.alias(name) for name, c in out.items()]


def normalise_records(df: DataFrame, module: Column | str, academic_year: Column | int, fields: dict[str, str] | None = None) -> DataFrame:
    """Source fields under stored names, module and year added, unknown fields dropped.

    For frames that have columns already. A reader that wants a schema knows one
    spelling of a field; records are landed as lines, with ``normalise_lines``.
    """
    pick = lambda source: F.col(source) if source in df.columns else None
    extra = [c for c in df.columns if c.startswith("_")]
    return df.select(*_stored(pick, fields or STUDENT_FIELDS, module, academic_year), *extra)


def normalise_lines(df: DataFrame, module: Column | str, academic_year: Column | int, column: str = "value", fields: dict[str, str] | None = None) -> DataFrame:
    """The same from one JSON record per line; exact spellings, several per stored name."""
    parsed = df.select(F.from_json(column, "map<string,string>").alias("_m"))
    pick = lambda source: F.try_element_at("_m", F.lit(source))
    return parsed.select(*_stored(pick, fields or STUDENT_FIELDS, module, academic_year))


def barcode_problem(col: Column) -> Column:
    """Why an application number is refused, or null."""
    text = col.cast("string")
    return F.when(text.isNull() | (F.trim(text) == ""), "barcode is blank").when(
        text.rlike(r"^\s*\d+\.\d+\s*$"), "barcode is a decimal number"
    )


def split_new(
    batch: DataFrame, key: list[str], required: list[str], order: str, existing: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) for an append under a unique key.

    A row with a null in the key never collides, as in SQL unique constraints.
    Among equal keys the row with the lowest ``order`` wins, then the lowest
    other values. Rejected rows carry ``reason`` and, for equal rows, how many
    ``copies`` there were. Equal rows are counted before they are shuffled, so
    a record that makes up much of the batch costs one row.
    """
    columns = batch.columns
    lacking = F.concat_ws(", ", *[F.when(F.col(c).isNull(), c) for c in required])
    checked = batch.withColumn("reason", F.when(lacking != "", F.concat(F.lit("missing "), lacking)))
    whole = all_of(F.col(k).isNotNull() for k in key)
    valid = checked.where(F.col("reason").isNull()).drop("reason")
    loose = valid.where(~whole)

    row = F.struct(order, *[c for c in columns if c != order and c not in key])
    counted = valid.where(whole).groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    first = counted.groupBy(*key).agg(F.min(row).alias("_first"))
    ranked = counted.join(first, key).withColumn("_wins", row == F.col("_first"))
    known = F.lit(False)
    if existing is not None:
        loaded = existing.select(*key).where(whole).distinct().withColumn("_known", F.lit(True))
        ranked = ranked.join(loaded, key, "left")
        known = F.col("_known").isNotNull()
    spare = F.when(known | ~F.col("_wins"), F.col("copies")).otherwise(F.col("copies") - 1)
    accepted = ranked.where(F.col("_wins") & ~known).select(*columns).unionByName(loose.select(*columns))
    repeated = ranked.select(
        *columns, F.when(known, "already loaded").otherwise("duplicate in batch").alias("reason"), spare.alias("copies")
    ).where("copies > 0")
    missing = checked.where(F.col("reason").isNotNull()).withColumn("copies", F.lit(1).cast("long"))
    return accepted, missing.unionByName(repeated)


def completeness(actual: DataFrame, expected: DataFrame, keys: list[str], type_key: str | None = None, counted: str | None = None) -> DataFrame:
    """Loaded against expected counts: ``missing``, ``done`` or ``excess``.

    ``expected`` has the keys and ``count``. A null type counts as 0. ``actual`` has a row for each record, or
    counts in the column ``counted``, such as landing keeps them.
    """
    def prepared(df: DataFrame) -> DataFrame:
        return df.fillna(0, [type_key]) if type_key else df

    number = F.sum(counted) if counted else F.count(F.lit(1))
    counts = prepared(actual).groupBy(*keys).agg(number.alias("loaded"))
    joined = prepared(expected).withColumnRenamed("count", "expected").join(counts, keys, "left").fillna(0, ["loaded"])
    status = (
        F.when(F.col("loaded") > F.col("expected"), "excess")
        .when(F.col("loaded") == F.col("expected"), "done").otherwise("missing")
    )
    return joined.withColumn("status", status)


def still_to_load(status: DataFrame) -> DataFrame:
    """Partitions that are not complete yet."""
    return status.where(F.col("status") == "missing")


def without_slice(df: DataFrame, module: str, academic_year: int, admission_type: int | None = None) -> DataFrame:
    """All rows but those of one module and year (and admission type)."""
    hit = (F.col("module") == module) & (F.col("academic_year") == academic_year)
    if admission_type is not None:
        hit = hit & (F.col("admission_type") == admission_type)
    return df.where(~F.coalesce(hit, F.lit(False)))


def drop_partition(spark: SparkSession, path: str, module: str, academic_year: int) -> bool:
    """Remove one (module, academic_year) folder of a landed table; True when it was there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/module={module}/academic_year={academic_year}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(folder, True)


def missing_log(df: DataFrame, columns: list[str], table: str = "students") -> DataFrame:
    """Missing values per column of one load, only columns that have some.

    Module and year (and the admission type of Diploma institutes) must be
    constant; otherwise the query fails with a message.
    """
    single = lambda c: F.count_distinct(F.col(c)) == 1
    constant = single("module") & single("academic_year")
    if table == "institutes":
        types = F.count_distinct(F.coalesce(F.col("admission_type").cast("string"), F.lit("")))
        constant = constant & ((F.min("module") != "Diploma") | (types == 1))
    counts = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), F.count_if(is_missing(F.col(c).cast("string"))).alias("missing"))
            for c in columns
        ]
    )
    one = df.agg(
        F.min("module").alias("module"), F.min("academic_year").alias("academic_year"),
        F.count(F.lit(1)).alias("records"), counts.alias("_c"), constant.alias("_constant"),
    )
    checked = one.withColumn(
        "_c",
        F.when(F.col("_constant"), F.col("_c")).otherwise(
            F.raise_error(F.lit("module, academic_year and admission_type must be constant in a load"))
        ),
    )
    return checked.select("module", "academic_year", "records", F.inline("_c")).where("missing > 0")


def expected_plan(modules: dict[str, tuple[int, int]], admission_types: dict[str, list[int]]) -> list[tuple]:
    """(module, year, admission type) triples to load; the type is None where unused."""
    return [
        (module, year, kind)
        for module, (first, last) in modules.items()
        for year in range(first, last + 1)
        for kind in admission_types.get(module, [None])
    ]


def expected_counts(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Expected counts from page totals reported by the source."""
    return pages.groupBy(*keys).agg(F.sum("records").alias("count"))
