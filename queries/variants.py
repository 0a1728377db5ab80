"""The report tables of one module, registered for the other, and the cross tables beside the main ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import standins as S, tables as T
from queries.base import query
from queries.datasets import ALONG, PLACES, _with, located
from rollbook.functions import payload as Y
from rollbook.operators import aggregate as A
from rollbook.plans import demand_tables as DM, enrollment_tables as ET, school_tables as ST, trainees as TR, vocational as VO

sql, ITI, DIPLOMA, iti, diploma = S.sql, T.ITI, T.DIPLOMA, T.iti, T.diploma


def cells(values, column: str, measure: str = "COUNT(DISTINCT aadhar_no)", more: str = "") -> str:
    return ", ".join(f"""{measure} FILTER ({column}='{v}') AS "{v}{more}" """ for v in values)


# --- over time ------------------------------------------------------------------------

@query("diploma_enrollments_over_time", sql(f"""SELECT academic_year AS "Year", COUNT(DISTINCT aadhar_no) AS "Num. students" FROM {DIPLOMA} GROUP BY 1"""))
def diploma_enrollments_over_time(t):
    return ET.enrollments_over_time(diploma(t))


@query("diploma_enrollments_over_time_by_type", sql(f"""
SELECT academic_year AS "Year", round_even(p::DOUBLE/(p+g)*100,1) AS "Pvt (%)", round_even(g::DOUBLE/(p+g)*100,1) AS "Govt (%)", p+g AS "Num. students" FROM
 (SELECT academic_year, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Govt.') AS g, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Pvt.') AS p FROM {DIPLOMA} AND academic_year>2017 GROUP BY 1)"""))
def diploma_enrollments_over_time_by_type(t):
    return ET.enrollments_by_type(diploma(t))


@query("diploma_institutes_over_time", sql("""SELECT academic_year AS "Year", COUNT(DISTINCT sams_code) AS "Num. institutes" FROM strength WHERE module='Diploma' GROUP BY 1"""))
def diploma_institutes_over_time(t):
    return ET.institutes_over_time(S.strength(t, "Diploma"))


_KINDS = T.KIND_ROWS.replace("'ITI'", "'Diploma'")


@query("diploma_enrollment_institutes_over_time", sql(f"""
SELECT "Year", COALESCE(g,0) AS "Govt._Num. students", COALESCE(p,0) AS "Pvt._Num. students", COALESCE(g+p,0) AS "Total_Num. students", COALESCE(ig,0) AS "Govt._Num. institutes",
 COALESCE(ip,0) AS "Pvt._Num. institutes", COALESCE(ig+ip,0) AS "Total_Num. institutes" FROM
 (SELECT academic_year AS "Year", COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Govt.') AS g, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Pvt.') AS p FROM {DIPLOMA} GROUP BY 1) FULL OUTER JOIN
 (SELECT academic_year AS "Year", COUNT(DISTINCT sams_code) FILTER (type_of_institute='Govt.') AS ig, COUNT(DISTINCT sams_code) FILTER (type_of_institute='Pvt.') AS ip FROM {_KINDS} GROUP BY 1) USING ("Year")"""))
def diploma_enrollment_institutes_over_time(t):
    return ET.enrollments_and_institutes(diploma(t), S.strength(t, "Diploma"))


@query("diploma_institutes_over_time_by_type", sql(f"""
SELECT academic_year AS "Year", g AS "Govt.", p AS "Pvt.", round_even(p::DOUBLE/(p+g)*100,1) AS "Pvt (%)", round_even(g::DOUBLE/(p+g)*100,1) AS "Govt (%)", p+g AS "Num. institutes" FROM
 (SELECT academic_year, COUNT(DISTINCT sams_code) FILTER (type_of_institute='Govt.') AS g, COUNT(DISTINCT sams_code) FILTER (type_of_institute='Pvt.') AS p FROM {_KINDS} GROUP BY 1)"""))
def diploma_institutes_over_time_by_type(t):
    return ET.institutes_by_type(S.strength(t, "Diploma"), diploma(t))


@query("iti_annual_income_over_time", sql(f"""SELECT academic_year AS "Year", {cells(T.INCOMES, 'annual_income')} FROM {ITI} GROUP BY 1"""))
def iti_income(t):
    return ET.category_over_time(iti(t), "annual_income", T.INCOMES)


@query("iti_share_below_income", sql(f"SELECT academic_year, round_even(COUNT(DISTINCT aadhar_no) FILTER (annual_income='0-2,50,000')::DOUBLE/COUNT(DISTINCT aadhar_no)*100,1) AS share_below FROM {ITI} GROUP BY 1"))
def iti_share_below(t):
    return ET.share_below_income(iti(t), ["0-2,50,000"])


SOCIAL = ["General", "OBC/SEBC", "SC", "ST", "Other"]


@query("iti_social_category_over_time", sql(f"""SELECT academic_year AS "Year", {cells(SOCIAL, 'social_category')} FROM {ITI} GROUP BY 1"""))
def iti_social(t):
    return ET.category_over_time(iti(t), "social_category", SOCIAL)


# --- one year -------------------------------------------------------------------------

@query("top_10_diploma_institutes_by_enrollment_2023", sql(T.RANKED.format(cols='reported_institute AS "Institute", type_of_institute AS "Type"', keys="reported_institute, type_of_institute", rows=DIPLOMA + " AND academic_year=2023", tail="ORDER BY n DESC, reported_institute LIMIT 10")))
def top_10_diploma_institutes(t):
    return ET.top_institutes(ET.in_year(diploma(t)))


@query("top_10_diplomas_by_num_branches_2023", sql(f"""
SELECT reported_institute AS "Institute", type_of_institute AS "Type", COUNT(DISTINCT branch) AS "Num. branches" FROM (SELECT DISTINCT sams_code, branch FROM strength WHERE module='Diploma' AND academic_year=2023) s
JOIN (SELECT DISTINCT sams_code, reported_institute, type_of_institute FROM {DIPLOMA} AND academic_year=2023) USING (sams_code) GROUP BY sams_code, 1, 2 ORDER BY 3 DESC, 1, sams_code LIMIT 10"""))
def top_10_diplomas_by_branches(t):
    return ET.top_institutes_by_courses(ET.in_year(S.strength(t, "Diploma")), ET.in_year(diploma(t)), "branch", "Num. branches")


for _module, _place, _rows in (("iti", "state", ITI), ("diploma", "district", DIPLOMA)):
    @query(f"{_module}_home_{_place}s_2023", sql(T.RANKED.format(cols=_place, keys=_place, rows=_rows + " AND academic_year=2023", tail="")))
    def home_places(t, module=_module, place=_place):
        return ET.home_places(ET.in_year((iti if module == "iti" else diploma)(t)), place)


@query("diploma_top_5_boards_2023", sql(T.RANKED.format(cols='highest_qualification_exam_board AS "Board"', keys="highest_qualification_exam_board", rows="marks WHERE module='Diploma' AND academic_year=2023", tail="ORDER BY n DESC, highest_qualification_exam_board LIMIT 5")))
def diploma_top_boards(t):
    return ET.top_boards(ET.in_year(S.mark_rows(t, "Diploma")))


@query("diploma_marks_by_gender_2023", sql("""
SELECT gender, ROUND(AVG(m.percentage),4) AS mean, ROUND(STDDEV_SAMP(m.percentage),4) AS std FROM marks m JOIN enrolled e USING (aadhar_no, academic_year) WHERE m.module='Diploma' AND e.module='Diploma' AND academic_year=2023 GROUP BY 1"""))
def diploma_marks_by_gender(t):
    return T.rounded(ET.marks_by_gender(ET.in_year(S.mark_rows(t, "Diploma")), ET.in_year(diploma(t))), 4, "mean", "std")


for _year in (2018, 2023):
    @query(f"diploma_locality_by_gender_{_year}", sql(f"""
    SELECT gender, NULLIF(COUNT(DISTINCT aadhar_no) FILTER (NOT local),0) AS "false", NULLIF(COUNT(DISTINCT aadhar_no) FILTER (local),0) AS "true" FROM {DIPLOMA} AND academic_year={_year} GROUP BY 1"""))
    def diploma_locality(t, year=_year):
        return ET.locality_by_gender(diploma(t), year)


@query("iti_income_by_category_2023", sql(f"""SELECT social_category AS "Social Category", {cells(T.INCOMES, 'annual_income')} FROM {ITI} AND academic_year=2023 GROUP BY 1"""))
def iti_income_by_category(t):
    return ET.income_by_category(ET.in_year(iti(t)), T.INCOMES)


_DIPLOMA_LEVELS = f"(SELECT gender, COALESCE(highest_qualification,'Unknown') AS q, aadhar_no FROM {DIPLOMA} AND academic_year=2023)"


@query("diploma_highest_qualification_by_gender_2023", sql(f"SELECT gender, {cells(T.LEVELS, 'q')} FROM {_DIPLOMA_LEVELS} GROUP BY 1"))
def diploma_levels(t):
    return ET.qualification_by_gender(ET.in_year(diploma(t)), T.LEVELS)[0]


def _shares(values, table: str) -> str:
    total = "+".join(f'"{v}"' for v in values)
    return f"""SELECT gender, {", ".join(f'round_even("{v}"::DOUBLE/total*100,1) AS "{v} (%)"' for v in values)}, total AS "Num. students" FROM (SELECT *, {total} AS total FROM ({table}))"""


@query("diploma_highest_qualification_by_gender_2023_pct", sql(_shares(T.LEVELS, f"SELECT gender, {cells(T.LEVELS, 'q')} FROM {_DIPLOMA_LEVELS} GROUP BY 1")))
def diploma_level_shares(t):
    return ET.qualification_by_gender(ET.in_year(diploma(t)), T.LEVELS)[1]


@query("iti_pass_by_gender_2023_pct", sql(_shares(T.EXAMS, "SELECT gender, " + cells(T.EXAMS, "exam_name", "COUNT(DISTINCT e.aadhar_no)") +
       " FROM enrolled e LEFT JOIN marks m ON m.module='ITI' AND e.aadhar_no=m.aadhar_no AND e.academic_year=m.academic_year WHERE e.module='ITI' AND e.academic_year=2023 GROUP BY 1")))
def pass_shares(t):
    return ET.examination_by_gender(ET.in_year(iti(t)), ET.in_year(S.mark_rows(t, "ITI")), T.EXAMS)[1]


# --- cross tables ---------------------------------------------------------------------

_CROSS = {
    "trades_by_category_2023": ("reported_branch_or_trade", "social_category", SOCIAL),
    "qualification_by_gender_counts_2023": ("highest_qualification", "gender", ET.GENDERS),
    "qualification_by_category_2023": ("highest_qualification", "social_category", SOCIAL),
}
for _name, (_index, _column, _values) in _CROSS.items():
    _counts = f"""SELECT {_index}, {cells(_values, _column, 'COUNT(aadhar_no)')}, COUNT(aadhar_no) FILTER ({_column} IN ({", ".join(f"'{v}'" for v in _values)})) AS "Total" FROM {ITI} AND academic_year=2023 AND {_index} IS NOT NULL GROUP BY 1"""

    @query(_name, sql(_counts))
    def cross_counts(t, index=_index, column=_column, values=tuple(_values)):
        return ET.cross_counts(ET.in_year(iti(t)), index, column, list(values))

    @query(f"{_name}_pct", sql(f"""SELECT {_index}, {", ".join(f'''CASE WHEN "Total">0 THEN printf('%.1f', "{v}"::DOUBLE/"Total"*100) END AS "{v}"''' for v in _values)}, "Total" FROM ({_counts})"""))
    def cross_shares(t, index=_index, column=_column, values=tuple(_values)):
        return ET.cross_percentages(ET.cross_counts(ET.in_year(iti(t)), index, column, list(values)), index)


@query("cutoff_by_trade_and_gender", sql("""
SELECT trade AS "Trade", round_even(AVG(cutoff) FILTER (gender='Female'),1) AS "Female", round_even(AVG(cutoff) FILTER (gender='Male'),1) AS "Male" FROM cutoffs WHERE module='ITI' AND academic_year=2023 GROUP BY 1"""))
def cutoff_by_trade_and_gender(t):
    return ET.mean_cutoffs(ET.cutoffs_with_type(ET.in_year(S.cutoff_rows(t)), ET.in_year(iti(t))), "gender", ET.GENDERS)


@query("iti_second_institute_cutoffs_2023", sql("""
SELECT trade AS "Trade", gender AS "Gender", round_even(AVG(cutoff) FILTER (social_category='UR'),1) AS "UR", round_even(AVG(cutoff) FILTER (social_category='SC'),1) AS "SC", CAST(NULL AS DOUBLE) AS "ST"
FROM cutoffs WHERE module='ITI' AND academic_year=2023 AND contains(institute_name,'ITI Supplier#00000001') AND qual='10th Pass' AND trade IN ('Brand#1','Brand#11') AND NOT contains(applicant_type,'OMC') GROUP BY 1,2"""))
def second_institute_cutoffs(t):
    return ET.institute_cutoffs(ET.in_year(S.cutoff_rows(t)), "ITI Supplier#00000001", "10th Pass", ["UR", "SC", "ST"], ["Brand#1", "Brand#11"], "OMC")


@query("distance_by_gender_2023", _with(PLACES + ",\n" + ALONG, f"""SELECT gender AS "Gender", {T.STATS} FROM (SELECT gender, distance AS v FROM located WHERE academic_year=2023) GROUP BY 1"""))
def distance_by_gender(t):
    return A.summary_stats(ET.in_year(located(t)), "distance", "gender", "Gender")


@query("vacancies_by_trade_2023", sql("""
SELECT trade, CAST(SUM(enrollment) AS BIGINT) AS enrollment, CAST(SUM(strength) AS BIGINT) AS strength, CAST(SUM(vacancies) AS BIGINT) AS vacancies, round_even(SUM(vacancies)::DOUBLE/SUM(strength),2) AS vacancy_ratio FROM vac WHERE academic_year=2023 GROUP BY 1"""))
def vacancies_by_trade(t):
    return ET.vacancy_totals(ET.in_year(S.vacancy_rows(t)), ["trade"])


@query("vacancy_ratio_by_trade_2023", sql(f"""SELECT trade AS "Trade", {T.STATS} FROM (SELECT trade, vacancy_ratio AS v FROM vac WHERE academic_year=2023) GROUP BY 1"""))
def vacancy_ratio_by_trade(t):
    return A.summary_stats(ET.in_year(S.vacancy_rows(t)), "vacancy_ratio", "trade", "Trade")


@query("students_admitted", sql(f"""
SELECT academic_year AS year, g+p AS "Total", g AS "Govt.", p AS "Pvt." FROM (SELECT academic_year, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Govt.') AS g, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Pvt.') AS p
FROM {ITI} AND academic_year>2017 GROUP BY 1)"""))
def students_admitted(t):
    return TR.admitted_students(iti(t), None, ET.KINDS)


@query("diploma_institutes_enrollments", sql("""
SELECT sams_code, module, academic_year, institute_name, category, arg_min(v, COALESCE(v,'~')) AS enrollments FROM (
 SELECT *, 'UR' AS category, CAST(a AS VARCHAR) AS v FROM inst UNION ALL SELECT *, 'SC', CAST(b AS VARCHAR) FROM inst) WHERE module='Diploma' GROUP BY 1,2,3,4,5"""))
def diploma_institutes_enrollments(t):
    return VO.institutes_enrollments(S.institutes(t, "Diploma"))


@query("quantiles_of_timestamps", """
SELECT event_type, ROUND(quantile_cont(x, 0.25), 1) AS p25, ROUND(quantile_cont(x, 0.5), 1) AS p50, ROUND(quantile_cont(x, 0.99), 1) AS p99 FROM (SELECT event_type, epoch_us(ts)/1000.0::DOUBLE AS x FROM events) GROUP BY 1""")
def quantiles_of_timestamps(t):
    """Values far from zero in a narrow range, which fall into few buckets."""
    from rollbook.operators.quantiles import quantiles

    rows = t.events.select("event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("x"))
    return T.rounded(quantiles(rows, "x", ["event_type"], {"p25": 0.25, "p50": 0.5, "p99": 0.99}), 1, "p25", "p50", "p99")


# --- seats, demand and compartments by place ----------------------------------------------

_PLACED = """d AS (SELECT 'ITI ' || s_name AS institute_name, n_name AS institute_district, 'ITI ' || s_name || ', ' || n_name AS institute_place FROM supplier JOIN nation ON s_nationkey=n_nationkey),
ps AS (SELECT * FROM seats JOIN d USING (institute_name)), pf AS (SELECT * FROM firsts JOIN d USING (institute_name))"""


def placed(t, rows):
    """Rows of institutes with their district, and institute and district in one name."""
    homes = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.concat(F.lit("ITI "), "s_name")
    places = homes.select(name.alias("institute_name"), F.col("n_name").alias("institute_district"), F.concat(name, F.lit(", "), "n_name").alias("institute_place"))
    return rows.drop("institute_district").join(places, "institute_name")


for _name, _unit in (("district", "institute_district"), ("institute_district", "institute_place")):
    @query(f"seats_against_demand_by_{_name}", _with(T.OPTIONS + ",\n" + _PLACED, f"""
    SELECT {_unit}, seats, applicants, seats-applicants AS available_seats, CASE WHEN applicants>seats*1.1 THEN 'Overutilized' WHEN applicants<seats*0.9 THEN 'Underutilized' ELSE 'Balanced' END AS utilisation
    FROM (SELECT {_unit}, SUM(strength) AS seats FROM ps GROUP BY 1) JOIN (SELECT {_unit}, COUNT(DISTINCT (academic_year, aadhar_no)) AS applicants FROM pf GROUP BY 1) USING ({_unit})"""))
    def demand_by_place(t, unit=_unit):
        s = DM.seats_by_year(placed(t, T.seats(t)), unit, T.YEARS)
        a = DM.applicants_by_year(placed(t, T.first_options(t)), unit, years=T.YEARS)
        return DM.seats_against_applicants(s, a, unit)


@query("hss_compartments_by_district", sql("""
SELECT district, COUNT(DISTINCT barcode) AS students, ROUND(100*COUNT(DISTINCT barcode)::DOUBLE/SUM(COUNT(DISTINCT barcode)) OVER (),6) AS share
FROM people WHERE module='HSS' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag='R') GROUP BY 1"""))
def hss_compartments_by_district(t):
    return T.rounded(ST.compartments_by(T.hss_students(t), "district"), 6, "share")


def _last_exam(t):
    """HSS students with the board and type of their first listed examination."""
    marks = Y.json_records(F.col("mark_data"), ["HighestQualificationExamBoard", "ExaminationType"])
    first = F.get(marks, 0)
    rows = T.hss_students(t)
    return rows.select("barcode", "compartmental_status", first["HighestQualificationExamBoard"].alias("board"), first["ExaminationType"].alias("examination_type"))


for _name, _value in (("board", "CASE WHEN l.l_linestatus='O' THEN 'BSE, ODISHA' ELSE 'CBSE' END"), ("examination_type", "'Annual'")):
    @query(f"hss_compartments_by_{_name}", sql(f"""
    SELECT {_name}, COUNT(DISTINCT barcode) AS students, ROUND(100*COUNT(DISTINCT barcode)::DOUBLE/SUM(COUNT(DISTINCT barcode)) OVER (),6) AS share FROM
     (SELECT barcode, {_value} AS {_name} FROM people JOIN line1 l ON o_orderkey=l.l_orderkey WHERE module='HSS' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag='R')) GROUP BY 1"""))
    def hss_compartments_by_exam(t, name=_name):
        return T.rounded(ST.compartments_by(_last_exam(t), name), 6, "share")


@query("marks_by_board", sql(f"""
SELECT highest_qualification_exam_board AS "Board", {T.STATS} FROM (SELECT highest_qualification_exam_board, percentage AS v FROM marks WHERE module='ITI' AND academic_year=2023) GROUP BY 1"""))
def marks_by_board(t):
    return A.summary_stats(ET.in_year(S.mark_rows(t, "ITI")), "percentage", "highest_qualification_exam_board", "Board")
