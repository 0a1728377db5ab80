"""ITI, Diploma and PDIS datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions import categories as C, payload as P, text as X, values as V
from rollbook.functions.geo import distance_km
from rollbook.functions.nulls import clean_strings, null_strict, real_id
from rollbook.operators.aggregate import count_by
from rollbook.operators.joins import join_renamed
from rollbook.operators.payloads import explode_records, list_to_long, map_to_long
from rollbook.operators.sets import distinct_values
from rollbook.operators.windows import first_rows

# Yes/No columns, and columns left out of the enrolment datasets.
FLAGS = [
    "had_two_year_full_time_work_exp_after_tenth", "gc", "es", "ews", "sports",
    "national_cadet_corps", "pm_care", "orphan",
]
DROPPED = [
    "student_name", "nationality", "domicile", "s_domicile_category",
    "outside_odisha_applicant_state_name", "odia_applicant_living_outside_odisha_state_name",
    "tenth_exam_school_address", "eighth_exam_school_address",
    "had_two_year_full_time_work_exp_after_tenth", "national_cadet_corps", "pm_care", "tfw",
]
# Fields of one marksheet and of one listed option.
MARK_FIELDS = [
    "ExamName", "YearofPassing", "RollNo", "ExaminationType", "TotalMarks", "SecuredMarks",
    "Percentage", "CompartmentalStatus", "CompartmentalFailMark", "SubjectWiseMarks",
    "HighestQualificationExamBoard", "HighestQualificationBoardExamName",
]
OPTION_FIELDS = ["Option_No", "Phase", "Institute_Name", "Trade", "Status"]
STRENGTH_IDS = ["sams_code", "trade", "branch", "module", "academic_year"]


def enrollments(df: DataFrame, module: str, sort: bool = False) -> DataFrame:
    """Clean enrolments of one module: typed flags and dates, address, locality, level.

    A person id that is the hash of nothing is no id, so such rows never meet in a join.

    Diploma adds the 10th passing year and takes a missing qualification from
    the marksheets; both are read from the row itself. ``sort`` orders the rows
    by person and date, which costs a shuffle of everything.
    """
    clean = clean_strings(df, null_strict)
    out = clean.withColumns(
        {
            "aadhar_no": real_id(F.col("aadhar_no")),
            "dob": V.to_timestamp_or_null(F.col("dob")),
            "date_of_application": V.to_timestamp_or_null(F.col("date_of_application")),
            "address": X.address_line(*[F.col(c) for c in ["address", "block", "district", "state", "pin_code"]]),
            "local": C.same_place(F.col("district"), F.col("institute_district")),
            "annual_income": C.income_label(F.col("annual_income"), module),
            **{c: V.yes_no(F.col(c)) for c in FLAGS if c in df.columns},
        }
    )
    level = F.col("highest_qualification")
    if module == "Diploma":
        marks = P.json_records(F.col("mark_data"), ["ExamName", "YearofPassing"])
        out = out.withColumn("tenth_passing_year", P.value_where(marks, "ExamName", "10th", "YearofPassing"))
        level = F.coalesce(level, C.highest_exam(F.transform(marks, lambda m: m["ExamName"])))
    out = out.withColumn("highest_qualification", C.standard_qualification(level))
    out = out.drop(*DROPPED).where(F.col("sams_code").isNotNull())
    return out.orderBy("aadhar_no", "date_of_application") if sort else out


def marks(enrolled: DataFrame) -> DataFrame:
    """One row per person, year and examination, with a checked percentage.

    The earliest application wins, and within it the first marksheet.
    """
    position = "_pos"
    parsed = P.json_records(F.col("mark_data"), MARK_FIELDS)
    ids = ["aadhar_no", "academic_year", "date_of_application", "barcode"]
    rows = enrolled.select(*ids, F.posexplode(parsed).alias(position, "_r"))
    flat = rows.select(
        *ids, position,
        *[F.col("_r").getField(f).alias(X.snake_name(f)) for f in MARK_FIELDS],
    )
    body = [X.snake_name(f) for f in MARK_FIELDS]
    earliest = F.col("date_of_application").asc_nulls_last()
    one = first_rows(flat, ["aadhar_no", "academic_year", "exam_name"], [earliest, "barcode", position, *body])
    typed = one.withColumns(
        {
            "secured_marks": V.number(F.col("secured_marks")),
            "total_marks": V.number(F.col("total_marks")),
            "percentage": V.marks_percentage(F.col("secured_marks"), F.col("total_marks")),
            "compartmental_status": V.yes_no(F.col("compartmental_status")),
        }
    ).withColumnRenamed("yearof_passing", "year_of_passing")
    return clean_strings(typed.drop(position, "barcode", "date_of_application"), null_strict)


def applications(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per listed option, with the person's number of applications.

    The number is the largest option number of the application; it is taken
    from the payload before it is unnested, so only one row per application is
    shuffled.
    """
    ids = keep or ["barcode", "aadhar_no", "academic_year"]
    options = P.json_records(F.col("option_data"), OPTION_FIELDS)
    listed = F.array_max(F.transform(options, lambda o: o["Option_No"].try_cast("int")))
    most = df.groupBy("barcode").agg(F.max(listed).alias("_most"))
    numbered = df.join(most, "barcode", "left").withColumn(
        "num_applications", F.coalesce("_most", F.lit(0)).cast("int")
    )
    return explode_records(numbered, "option_data", OPTION_FIELDS, [*ids, "num_applications"])


def institutes_strength(df: DataFrame) -> DataFrame:
    """Seats per category: one row per institute row and category of any institute."""
    long = map_to_long(df, "strength", STRENGTH_IDS, "category", "strength")
    return long.withColumns(
        {"category": C.strength_category(F.col("category")), "strength": V.number(F.col("strength"))}
    )


def institutes_cutoffs(df: DataFrame) -> DataFrame:
    """Cutoff marks per selection stage and applicant type, with the type decoded."""
    ids = ["sams_code", "trade", "academic_year", "institute_name"]
    long = list_to_long(df, "cutoff", ids, "SelectionStage", "selection_stage", "applicant_type", "cutoff")
    label = F.col("applicant_type")
    return long.withColumns(
        {
            "cutoff": V.number(F.col("cutoff")),
            "local": C.cutoff_is_local(label),
            "qual": C.cutoff_qualification(label),
            "social_category": C.cutoff_category(label),
            "gender": C.cutoff_gender(label),
        }
    )


def institutes_enrollments(df: DataFrame) -> DataFrame:
    """Enrolment counts per category, one row per institute, year and category."""
    ids = ["sams_code", "module", "academic_year", "institute_name"]
    long = map_to_long(df, "enrollment", ids, "category", "enrollments")
    order = ["module", "institute_name", F.col("enrollments").asc_nulls_last()]
    return first_rows(long, ["sams_code", "academic_year", "category"], order)


def institute_addresses(df: DataFrame) -> DataFrame:
    """Addresses by institute code, from the published list with spaced headers."""
    named = df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])
    return named.select(
        F.col("iti_code").alias("ncvtmis_code"),
        X.institute_address(F.col("address"), F.col("district"), F.col("state")).alias("address"),
        "state", "district",
    )


def geocodes(sources: list[DataFrame], columns: list[str], known: DataFrame) -> DataFrame:
    """Distinct addresses of each source with coordinates from a supplied table."""
    if len(sources) != len(columns):
        raise ValueError("as many address columns as sources are needed")
    addresses = distinct_values(list(zip(sources, columns)), "address")
    return addresses.join(known.select("address", "longitude", "latitude"), "address", "left")


def geocoded_count(coded: DataFrame) -> DataFrame:
    return coded.agg(
        F.count_distinct("address").alias("addresses"),
        F.count_distinct(F.when(F.col("latitude").isNotNull(), F.col("address"))).alias("geocoded"),
    )


def geocoded_institutes(institutes: DataFrame, addresses: DataFrame, coded: DataFrame) -> DataFrame:
    """Coordinates per institute id."""
    placed = addresses.join(coded, "address", "left")
    pairs = institutes.select("ncvtmis_code", "sams_code").distinct()
    return pairs.join(placed, "ncvtmis_code", "left").select("sams_code", "latitude", "longitude")


def geocoded_enrollments(enrolled: DataFrame, coded: DataFrame, institutes: DataFrame | None = None) -> DataFrame:
    """Enrolments with the student's point and, given institutes, theirs and the distance."""
    out = enrolled.join(
        coded.select("address", F.col("latitude").alias("student_lat"), F.col("longitude").alias("student_long")),
        "address", "left",
    )
    if institutes is None:
        return out
    out = out.join(
        institutes.select("sams_code", F.col("latitude").alias("institute_lat"), F.col("longitude").alias("institute_long")),
        "sams_code", "left",
    )
    points = [F.col(c).cast("double") for c in ["student_lat", "student_long", "institute_lat", "institute_long"]]
    return out.withColumn("distance", distance_km(*points))


def marks_and_cutoffs(enrolled: DataFrame, mark_rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Marks above the cutoff that applied to the person, one row per person and cutoff."""
    people = enrolled.select(
        "aadhar_no", "academic_year", "reported_branch_or_trade", "phase", "sams_code", "gender",
        C.reservation_category(*[F.col(c) for c in ["social_category", "orphan", "gc", "ph", "es", "ews"]]).alias("social_category"),
        C.same_place(F.col("district"), F.col("institute_district")).alias("local"),
    ).withColumn("phase", F.coalesce(F.col("phase").try_cast("int"), F.lit(-1)))
    scored = mark_rows.join(people, ["aadhar_no", "academic_year"])
    limits = cutoffs.withColumn("selection_stage", F.col("selection_stage").try_cast("int"))
    keys = ["sams_code", "academic_year", "social_category", "gender", "local"]
    named = limits.select(
        *keys, F.col("trade"), F.col("qual"), F.col("selection_stage").alias("phase"), "cutoff", "institute_name"
    )
    matched = scored.withColumnsRenamed({"reported_branch_or_trade": "trade", "exam_name": "qual"}).join(
        named, [*keys, "trade", "qual", "phase"]
    )
    slim = matched.drop(
        "compartmental_status", "compartmental_fail_mark", "highest_qualification_board_exam_name", "phase"
    )
    unique = ["aadhar_no", "academic_year", "sams_code", "trade", "social_category", "gender", "local", "qual"]
    one = first_rows(slim, unique, ["cutoff", "percentage", "roll_no"])
    return one.where(F.col("percentage") > F.col("cutoff"))


def vacancies(enrolled: DataFrame, strength: DataFrame) -> DataFrame:
    """Seats, enrolments, vacancies and their ratio per institute, year and trade."""
    keys = ["sams_code", "academic_year", "reported_branch_or_trade", "type_of_institute"]
    taken = count_by(enrolled, keys, "enrollment", "aadhar_no").withColumnRenamed("reported_branch_or_trade", "trade")
    seats = strength.where(F.col("category") == "Total").drop("branch")
    joined = taken.join(seats, ["sams_code", "academic_year", "trade"])
    left = F.col("strength") - F.col("enrollment")
    return joined.select(
        "sams_code", "academic_year", "trade", "type_of_institute", "module", "category",
        F.col("enrollment").cast("int").alias("enrollment"), F.col("strength").cast("int").alias("strength"),
        left.cast("int").alias("vacancies"), V.vacancy_ratio(left, F.col("strength")).alias("vacancy_ratio"),
    )


def district_populations(villages: DataFrame, district: str = "District", population: str = "Vill Population+") -> DataFrame:
    """Population per district from village rows."""
    summed = villages.groupBy(F.col(f"`{district}`").alias("district")).agg(
        F.sum(F.col(f"`{population}`").try_cast("double")).cast("long").alias("population")
    )
    return summed.where(F.col("district").isNotNull()).withColumn("district", X.title(F.col("district")))
