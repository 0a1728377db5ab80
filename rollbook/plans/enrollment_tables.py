"""Report tables on enrolment, institutes, trades, marks, cutoffs and vacancies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions import categories as C, values as V
from rollbook.operators import aggregate as A, reshape as R
from rollbook.operators.fuzzy import fuzzy_join
from rollbook.operators.joins import outer_fill
from rollbook.operators.spatial import within_any
from rollbook.operators.windows import top_overall, top_rows

KINDS = ["Govt.", "Pvt."]
GENDERS = ["Female", "Male"]
STUDENTS = "Num. students"
INSTITUTES = "Num. institutes"
TRADE = "reported_branch_or_trade"


def in_year(df: DataFrame, year: int = 2023) -> DataFrame:
    return df.where(F.col("academic_year") == year)


def enrollments_over_time(enrolled: DataFrame) -> DataFrame:
    return A.count_distinct_by(enrolled, ["academic_year"], "aadhar_no", STUDENTS).withColumnRenamed("academic_year", "Year")


def combined_over_time(iti: DataFrame, diploma: DataFrame, measure: str) -> DataFrame:
    """Two yearly tables side by side, after 2017."""
    named = [iti.withColumnRenamed(measure, "ITI"), diploma.withColumnRenamed(measure, "Diploma")]
    joined = named[0].join(named[1], "Year", "full_outer")
    return joined.where(F.col("Year") > 2017)


def enrollments_by_type(enrolled: DataFrame) -> DataFrame:
    """Shares of private and government institutes per year after 2017."""
    table = R.pivot_distinct(enrolled.where(F.col("academic_year") > 2017), ["academic_year"], "type_of_institute", "aadhar_no", KINDS, rest=True)
    out = R.row_percentages(table, ["Pvt.", "Govt."], STUDENTS, ["Pvt (%)", "Govt (%)"], [1, 1])
    return out.withColumnRenamed("academic_year", "Year")


def pipeline_shares(pipeline: DataFrame) -> DataFrame:
    """The last four columns as percentages of their sum."""
    labels = ["11th std. admitted (%)", "ITI admitted (%)", "Diploma admitted (%)", "Assumed Dropouts (%)"]
    return R.row_percentages(pipeline, pipeline.columns[-4:], "_total", labels, [1] * 4).drop("_total")


def institutes_over_time(strength: DataFrame) -> DataFrame:
    return A.count_distinct_by(strength, ["academic_year"], "sams_code", INSTITUTES).withColumnRenamed("academic_year", "Year")


def _with_kind(strength: DataFrame, enrolled: DataFrame) -> DataFrame:
    kinds = enrolled.select("sams_code", "type_of_institute").distinct()
    return strength.select("sams_code", "academic_year").distinct().join(kinds, "sams_code", "left")


def enrollments_and_institutes(enrolled: DataFrame, strength: DataFrame) -> DataFrame:
    """Students and institutes per year and type, columns "<type>_<measure>"."""
    def measure(df: DataFrame, column: str, label: str) -> DataFrame:
        wide = R.pivot_distinct(df, ["academic_year"], "type_of_institute", column, KINDS, rest=True)
        total = R.with_row_total(wide, ["academic_year"], first=False)
        return R.wide_to_long(total, ["academic_year"], [*KINDS, "Total"], "type_of_institute", label)

    long = outer_fill(
        [measure(enrolled, "aadhar_no", STUDENTS), measure(_with_kind(strength, enrolled), "sams_code", INSTITUTES)],
        ["academic_year", "type_of_institute"],
    )
    return R.pivot_measures(
        long, ["academic_year"], "type_of_institute",
        {INSTITUTES: F.sum(f"`{INSTITUTES}`"), STUDENTS: F.sum(f"`{STUDENTS}`")}, [*KINDS, "Total"],
    ).withColumnRenamed("academic_year", "Year")


def graduation_gap(enrolled: DataFrame, mark_rows: DataFrame) -> DataFrame:
    """Years between passing the last examination and applying, in three classes."""
    rows = enrolled.select("aadhar_no", "academic_year", "date_of_application").join(
        mark_rows.select("aadhar_no", "academic_year", "year_of_passing"), ["aadhar_no", "academic_year"]
    )
    gap = F.year("date_of_application") - F.col("year_of_passing").try_cast("int")
    counts = rows.groupBy(V.gap_class(gap).alias("Years since graduation")).agg(F.count(F.lit(1)).alias(STUDENTS))
    total = counts.agg(F.sum(f"`{STUDENTS}`")).scalar()
    return counts.withColumn("Share (%)", V.round_half_even(F.col(f"`{STUDENTS}`") / total * 100, 2))


def trades_by_gender(enrolled: DataFrame) -> DataFrame:
    """Persons per year, gender and trade, with their share of the year and gender."""
    keys = ["academic_year", "gender"]
    counts = A.count_distinct_by(enrolled, [*keys, TRADE], "aadhar_no", "students")
    return A.share_of_total(counts, "students", keys, "share")


def top_trades_over_time(enrolled: DataFrame, gender: str, k: int = 5) -> DataFrame:
    """The k most chosen trades of each year, long form."""
    rows = trades_by_gender(enrolled).where(F.col("gender") == gender)
    best = top_rows(rows, ["academic_year"], [F.desc("students"), TRADE], k)
    return best.select(
        F.col("academic_year").alias("Year"), F.col(TRADE).alias("Trade"),
        F.col("students").alias(STUDENTS), F.col("share").alias("Share"),
    )


def top_trades_over_time_wide(enrolled: DataFrame, gender: str, k: int = 5) -> DataFrame:
    """The same with one pair of columns per trade."""
    long = top_trades_over_time(enrolled, gender, k)
    pair = {STUDENTS: F.max(f"`{STUDENTS}`"), "Share": F.max("Share")}
    named = [m.alias(n) for n, m in pair.items()]
    return long.groupBy("Year").pivot("Trade").agg(*named)


def _ranked(enrolled: DataFrame, keys: dict[str, str], k: int | None, share: str, digits: int, scale: float, by_share: bool = False) -> DataFrame:
    counts = A.count_distinct_by(enrolled, list(keys), "aadhar_no", "_n")
    shared = A.share_of_total(counts, "_n", None, "_s", scale).withColumn("_s", V.round_half_even(F.col("_s"), digits))
    if k:
        first = [F.desc("_s")] if by_share else []
        shared = top_overall(shared, [*first, F.desc("_n"), *keys], k)
    return shared.select(
        *[F.col(c).alias(label) for c, label in keys.items()], F.col("_n").alias(STUDENTS), F.col("_s").alias(share)
    )


def top_trades(enrolled_in_year: DataFrame, gender: str, k: int = 5) -> DataFrame:
    return _ranked(enrolled_in_year.where(F.col("gender") == gender), {TRADE: "Trade"}, k, "Share", 2, 1.0, True)


def top_by_enrollment(enrolled_in_year: DataFrame, label: str = "Trade", k: int = 10) -> DataFrame:
    """Most chosen trades (ITI) or branches (Diploma)."""
    return _ranked(enrolled_in_year, {TRADE: label}, k, "Share (%)", 1, 100.0)


def top_institutes(enrolled_in_year: DataFrame, k: int = 10) -> DataFrame:
    return _ranked(enrolled_in_year, {"reported_institute": "Institute", "type_of_institute": "Type"}, k, "Share (%)", 1, 100.0)


def home_places(enrolled_in_year: DataFrame, place: str = "district") -> DataFrame:
    """Persons and share per home district or state."""
    return _ranked(enrolled_in_year, {place: place}, None, "Share (%)", 1, 100.0)


def top_boards(marks_in_year: DataFrame, k: int = 5) -> DataFrame:
    """Boards with most persons; shares are of all boards."""
    return _ranked(marks_in_year, {"highest_qualification_exam_board": "Board"}, k, "Share (%)", 1, 100.0)


def institutes_by_type(strength: DataFrame, enrolled: DataFrame) -> DataFrame:
    table = R.pivot_distinct(_with_kind(strength, enrolled), ["academic_year"], "type_of_institute", "sams_code", KINDS, rest=True)
    out = R.row_percentages(table, ["Pvt.", "Govt."], INSTITUTES, ["Pvt (%)", "Govt (%)"], [1, 1], drop=False)
    return out.withColumnRenamed("academic_year", "Year")


def courses_over_time(strength: DataFrame, course: str, label: str) -> DataFrame:
    """Distinct trades or branches per year."""
    return A.count_distinct_by(strength, ["academic_year"], course, label).withColumnRenamed("academic_year", "Year")


def top_institutes_by_courses(strength_in_year: DataFrame, enrolled_in_year: DataFrame, course: str, label: str, k: int = 10) -> DataFrame:
    """Institutes with most trades or branches."""
    names = enrolled_in_year.select("sams_code", "reported_institute", "type_of_institute").distinct()
    rows = strength_in_year.select("sams_code", course).distinct().join(names, "sams_code", "left")
    counts = A.count_distinct_by(rows, ["sams_code", "reported_institute", "type_of_institute"], course, "_n")
    best = top_overall(counts, [F.desc("_n"), "reported_institute", "sams_code"], k)
    return best.select(
        F.col("reported_institute").alias("Institute"), F.col("type_of_institute").alias("Type"), F.col("_n").alias(label)
    )


def student_locations(enrolled_in_year: DataFrame) -> DataFrame:
    return A.count_distinct_by(enrolled_in_year, ["student_long", "student_lat"], "aadhar_no", STUDENTS)


def institute_points(enrolled_in_year: DataFrame, edges: DataFrame, cell: float | None = None) -> DataFrame:
    """Institutes with their point and persons, inside the polygons only."""
    known = A.with_keys(enrolled_in_year, ["type_of_institute", "reported_institute"])
    point = F.struct("institute_long", "institute_lat")
    sums = known.groupBy("type_of_institute", "reported_institute").agg(
        F.count_distinct("aadhar_no").alias(STUDENTS), F.min(F.when(F.col("institute_lat").isNotNull(), point)).alias("_p")
    )
    placed = sums.select("type_of_institute", "reported_institute", F.col(f"`{STUDENTS}`"), "_p.*")
    return within_any(placed, edges, "institute_long", "institute_lat", cell)


def enrollment_by_shape(shapes: DataFrame, enrolled_in_year: DataFrame, fuzzy_on: str, exact_on: list[str] | None = None) -> DataFrame:
    """Shapes with the persons of the best matching block or state name."""
    counts = A.count_distinct_by(enrolled_in_year, [*(exact_on or []), fuzzy_on], "aadhar_no", "aadhar_no")
    return fuzzy_join(shapes, counts, fuzzy_on, exact_on, "left")


def marks_histogram(frames: dict[str, DataFrame], width: float = 1.0) -> DataFrame:
    """Counts of percentages in centred bins, per module and over all."""
    parts = [df.select(F.lit(name).alias("module"), "percentage") for name, df in frames.items()]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    each = A.centred_histogram(stacked, "percentage", width, ["module"])
    both = each.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit("All").alias("module"), "bin", "n")
    return each.unionByName(both)


def marks_by_gender(marks_in_year: DataFrame, enrolled_in_year: DataFrame) -> DataFrame:
    people = enrolled_in_year.select("aadhar_no", "academic_year", "gender")
    return A.mean_std_by(marks_in_year.join(people, ["aadhar_no", "academic_year"]), ["gender"], "percentage")


def locality_by_gender(enrolled: DataFrame, year: int) -> DataFrame:
    rows = in_year(enrolled, year).withColumn("local", F.col("local").cast("string"))
    return R.pivot(rows, ["gender"], "local", F.count_distinct("aadhar_no"), ["false", "true"])


def locality_and_distance(enrolled_in_year: DataFrame) -> DataFrame:
    return R.pivot_mean(enrolled_in_year, ["local"], "gender", "distance", GENDERS)


def category_over_time(enrolled: DataFrame, column: str, values: list[str] | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """Persons per year and income or social category."""
    table = R.pivot_distinct(enrolled, ["academic_year"], column, "aadhar_no", values)
    return table.withColumnsRenamed({"academic_year": "Year", **(rename or {})})


def income_by_category(enrolled_in_year: DataFrame, incomes: list[str] | None = None) -> DataFrame:
    table = R.pivot_distinct(enrolled_in_year, ["social_category"], "annual_income", "aadhar_no", incomes)
    return table.withColumnRenamed("social_category", "Social Category")


def share_below_income(enrolled: DataFrame, low: list[str]) -> DataFrame:
    """Percent of each year's persons whose income class is among the lower ones."""
    hit = F.count_distinct(F.when(F.col("annual_income").isin(low), F.col("aadhar_no")))
    return enrolled.groupBy("academic_year").agg(
        V.round_half_even(hit / F.count_distinct("aadhar_no") * 100, 1).alias("share_below")
    )


def _levels_and_shares(rows: DataFrame, column: str, values: list[str] | None) -> tuple[DataFrame, DataFrame]:
    levels = R.pivot_distinct(rows, ["gender"], column, "aadhar_no", values, rest=True)
    cells = [c for c in levels.columns if c not in ("gender", R.REST)]
    shares = R.row_percentages(levels, cells, STUDENTS, [f"{c} (%)" for c in cells], [1] * len(cells))
    return levels.drop(R.REST), shares


def qualification_by_gender(enrolled_in_year: DataFrame, values: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Levels and percentages; a missing qualification counts as Unknown."""
    rows = enrolled_in_year.withColumn("highest_qualification", F.coalesce("highest_qualification", F.lit("Unknown")))
    return _levels_and_shares(rows, "highest_qualification", values)


def examination_by_gender(enrolled_in_year: DataFrame, marks_in_year: DataFrame, values: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    exams = marks_in_year.select("aadhar_no", "academic_year", "exam_name")
    rows = enrolled_in_year.select("aadhar_no", "academic_year", "gender").join(exams, ["aadhar_no", "academic_year"], "left")
    return _levels_and_shares(rows, "exam_name", values)


def institute_cutoffs(cutoffs_in_year: DataFrame, institute: str, qual: str, categories: list[str], trades: list[str], without: str) -> DataFrame:
    """Mean cutoffs of one institute by trade, gender and category."""
    rows = cutoffs_in_year.where(
        F.col("institute_name").contains(institute) & (F.col("qual") == qual)
        & F.col("social_category").isin(categories) & F.col("trade").isin(trades)
        & ~F.col("applicant_type").contains(without)
    )
    table = R.pivot_mean(rows, ["trade", "gender"], "social_category", "cutoff", categories)
    return table.withColumnsRenamed({"trade": "Trade", "gender": "Gender"})


def vacancy_histogram(vacancy_rows: DataFrame, kind: str, width: float = 1.0) -> DataFrame:
    """Institutes per vacancy ratio in percent, centred bins."""
    sums = A.sum_by(vacancy_rows.where(F.col("type_of_institute") == kind), ["sams_code"], ["vacancies", "strength"])
    ratio = sums.withColumn("vacancy_ratio", V.vacancy_ratio(F.col("vacancies"), F.col("strength"), percent=True))
    return A.centred_histogram(ratio, "vacancy_ratio", width)


# --- cross tables -----------------------------------------------------------------

def cross_counts(rows: DataFrame, index: str, column: str, values: list[str] | None = None) -> DataFrame:
    """Rows per cell, with the total last."""
    return R.with_row_total(R.pivot_count(rows, [index], column, values, "aadhar_no", rest=True), [index], first=False)


def cross_percentages(counts: DataFrame, index: str, as_text: bool = True) -> DataFrame:
    """Cells as a percentage of the row total, one decimal."""
    cells = [c for c in counts.columns if c not in (index, "Total")]
    share = lambda c: F.try_divide(F.col(f"`{c}`"), F.col("Total")) * 100
    shown = [(V.fixed_decimals(share(c)) if as_text else share(c)).alias(c) for c in cells]
    return counts.select(index, *shown, "Total")


def cutoffs_with_type(cutoffs_in_year: DataFrame, enrolled_in_year: DataFrame) -> DataFrame:
    """Cutoffs with the institute type and a coarse social category."""
    kinds = enrolled_in_year.select("sams_code", "type_of_institute").distinct()
    return cutoffs_in_year.join(kinds, "sams_code", "left").withColumn("social_category", C.coarse_category(F.col("social_category")))


def mean_cutoffs(cutoffs: DataFrame, column: str, values: list[str] | None = None) -> DataFrame:
    return R.pivot_mean(cutoffs, ["trade"], column, "cutoff", values).withColumnRenamed("trade", "Trade")


def vacancy_totals(vacancy_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Summed seats, enrolments and vacancies, and the ratio to two decimals."""
    sums = A.sum_by(vacancy_rows, keys, ["enrollment", "strength", "vacancies"])
    ratio = V.round_half_even(V.vacancy_ratio(F.col("vacancies"), F.col("strength")), 2)
    return sums.withColumn("vacancy_ratio", ratio)


def vacancies_by_institute(vacancy_rows: DataFrame, enrolled_in_year: DataFrame) -> DataFrame:
    names = enrolled_in_year.select("sams_code", "reported_institute", "institute_district", "type_of_institute").distinct()
    return names.join(vacancy_totals(vacancy_rows, ["sams_code"]), "sams_code", "right")


def most_and_least(df: DataFrame, measure: str, ties: list[str], k: int = 10) -> tuple[DataFrame, DataFrame]:
    """The k rows with the highest and the k with the lowest measure."""
    high = top_overall(df, [F.col(measure).desc_nulls_last(), *ties], k)
    low = top_overall(df, [F.col(measure).asc_nulls_last(), *ties], k)
    return high, low


def female_share(rows: DataFrame, index: str, digits: int = 2) -> DataFrame:
    counts = R.pivot(rows, [index], "gender", F.count("aadhar_no"), GENDERS)
    share = F.try_divide(F.col("Female"), F.col("Female") + F.col("Male"))
    return counts.withColumn("Female share", V.round_half_even(share, digits))
