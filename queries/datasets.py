"""Cleaned and joined datasets over the stand-in records."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import standins as S
from queries.base import described_once, query
from rollbook.functions import categories as C, identity as I, payload as Y, text as X, values as V
from rollbook.functions.geo import distance_km
from rollbook.operators import aggregate as A, joins as J, payloads as PL
from rollbook.plans import higher as H, identity as ID, trainees as TR, vocational as VO
from rollbook.sources import landing as L

sql = S.sql


def _with(extra: str, body: str) -> str:
    """The stand-in CTEs, more CTEs, then the body."""
    return f"WITH {S.CTES.strip()},\n{extra}\n{body.strip()}"

ENROLLED = """barcode, aadhar_no, academic_year, gender, dob, social_category, district, address, annual_income, phase, date_of_application,
 orphan, gc, es, ews, sams_code, reported_institute, reported_branch_or_trade, institute_district, type_of_institute, course_period, local, highest_qualification"""
ENROLLED_COLUMNS = [c.strip() for c in ENROLLED.replace("\n", " ").split(",")]


def _typed(df):
    """Dates as text, which both engines print alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ["dob", "date_of_application"]})


ENROLLED_SQL = ENROLLED.replace("dob,", "strftime(dob, '%Y-%m-%d') AS dob,").replace("date_of_application,", "strftime(date_of_application, '%Y-%m-%d') AS date_of_application,")


@query("iti_enrollments", sql(f"SELECT {ENROLLED_SQL} FROM enrolled WHERE module='ITI'"))
def iti_enrollments(t):
    return _typed(S.enrolled(t, "ITI")).select(ENROLLED_COLUMNS)


@query("diploma_enrollments", sql(f"""
SELECT {ENROLLED_SQL}, tenth FROM enrolled LEFT JOIN (SELECT l_orderkey AS o_orderkey, CAST(arg_min(year(l_shipdate)-l_linenumber+1, (l_linenumber, l_suppkey, l_partkey, l_extendedprice)) AS VARCHAR) AS tenth
 FROM lineitem WHERE l_returnflag='A' GROUP BY 1) USING (o_orderkey) WHERE module='Diploma'"""))
def diploma_enrollments(t):
    return _typed(S.enrolled(t, "Diploma")).select(*ENROLLED_COLUMNS, F.col("tenth_passing_year").alias("tenth"))


@query("pdis_enrollments", sql(f"SELECT {ENROLLED_SQL} FROM enrolled WHERE module='PDIS'"))
def pdis_enrollments(t):
    return _typed(S.enrolled(t, "PDIS")).select(ENROLLED_COLUMNS)


MARKS = "aadhar_no, academic_year, exam_name, roll_no, secured_marks, total_marks, ROUND(percentage,4) AS percentage, year_of_passing, highest_qualification_exam_board, compartmental_status"


def _marks(t, module):
    return S.mark_rows(t, module).select(
        "aadhar_no", "academic_year", "exam_name", "roll_no", "secured_marks", "total_marks", F.round("percentage", 4).alias("percentage"),
        "year_of_passing", "highest_qualification_exam_board", "compartmental_status")


@query("iti_marks", sql(f"SELECT {MARKS} FROM marks WHERE module='ITI'"))
def iti_marks(t):
    return _marks(t, "ITI")


@query("diploma_marks", sql(f"SELECT {MARKS} FROM marks WHERE module='Diploma'"))
def diploma_marks(t):
    return _marks(t, "Diploma")


@query("pdis_marks", sql(f"SELECT {MARKS} FROM marks WHERE module='PDIS'"))
def pdis_marks(t):
    return _marks(t, "PDIS")


APPLICATIONS = """SELECT barcode, aadhar_no, academic_year, CAST(MAX(l_linenumber) OVER (PARTITION BY barcode) AS INTEGER) AS num_applications, CAST(l_linenumber AS VARCHAR) AS option_no,
 '1' AS phase, inst AS institute_name, p_brand AS trade, status FROM people JOIN lines ON o_orderkey=l_orderkey WHERE module='{m}'
 UNION ALL SELECT barcode, aadhar_no, academic_year, 0, NULL, NULL, NULL, NULL, NULL FROM people WHERE module='{m}' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""


@query("iti_applications", sql(APPLICATIONS.format(m="ITI")))
def iti_applications(t):
    return VO.applications(S.students(t, "ITI"))


@query("diploma_applications", sql(APPLICATIONS.format(m="Diploma")))
def diploma_applications(t):
    return VO.applications(S.students(t, "Diploma"))


@query("iti_institutes_strength", sql("SELECT * FROM strength WHERE module='ITI'"))
def iti_institutes_strength(t):
    return S.strength(t, "ITI")


@query("diploma_institutes_strength", sql("SELECT * FROM strength WHERE module='Diploma'"))
def diploma_institutes_strength(t):
    return S.strength(t, "Diploma")


@query("iti_institutes_cutoffs", sql("""
SELECT sams_code, trade, academic_year, institute_name, selection_stage, applicant_type, cutoff, local, qual, social_category, gender FROM cutoffs WHERE module='ITI'"""))
def iti_institutes_cutoffs(t):
    return S.cutoff_rows(t)


@query("iti_institutes_enrollments", sql("""
SELECT sams_code, module, academic_year, institute_name, category, arg_min(v, COALESCE(v,'~')) AS enrollments FROM (
 SELECT *, 'UR' AS category, CAST(a AS VARCHAR) AS v FROM inst UNION ALL SELECT *, 'SC', CAST(b AS VARCHAR) FROM inst) WHERE module='ITI' GROUP BY 1,2,3,4,5"""))
def iti_institutes_enrollments(t):
    return VO.institutes_enrollments(S.institutes(t, "ITI"))


def raw_addresses(t):
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return places.select(F.concat(F.lit("N"), "s_suppkey").alias("ITI Code"), F.col("s_name").alias("Address"), F.col("r_name").alias("State"), F.col("n_name").alias("District"))


@described_once
def known_places(t):
    """Coordinates per address, derived from balances and nations."""
    home = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    block = F.concat(F.lit("Block "), "c_mktsegment")
    pin = F.concat(F.lit("75"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"))
    students = t.customer.join(home, F.col("c_nationkey") == F.col("n_nationkey")).select(
        X.address_line(F.col("c_name"), block, F.col("n_name"), F.col("r_name"), pin).alias("address"),
        (82 + F.col("c_nationkey") / 5).alias("longitude"), (18 + F.col("c_acctbal") / 2500).alias("latitude"))
    institutes = t.supplier.join(home, F.col("s_nationkey") == F.col("n_nationkey")).select(
        X.institute_address(F.col("s_name"), F.col("n_name"), F.col("r_name")).alias("address"),
        (82 + F.col("s_nationkey") / 5).alias("longitude"), (18 + F.col("s_acctbal") / 2500).alias("latitude"))
    return students.where("latitude < 21.9").unionByName(institutes)


PLACES = """raw_addr AS (SELECT 'N' || s_suppkey AS ncvtmis_code, s_name || ', ' || n_name || ', ' || r_name AS address, r_name AS state, n_name AS district, s_suppkey,
 82 + s_nationkey/5.0::DOUBLE AS longitude, 18 + s_acctbal/2500 AS latitude FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey),
known AS (SELECT DISTINCT address, 82 + c_nationkey/5.0::DOUBLE AS longitude, 18 + c_acctbal/2500 AS latitude FROM people WHERE 18 + c_acctbal/2500 < 21.9
 UNION ALL SELECT address, longitude, latitude FROM raw_addr)"""


@query("iti_addresses", _with(PLACES, "SELECT ncvtmis_code, address, state, district FROM raw_addr"))
def iti_addresses(t):
    return VO.institute_addresses(raw_addresses(t))


@described_once
def coded(t):
    return VO.geocodes([S.enrolled(t, "ITI"), S.enrolled(t, "Diploma"), VO.institute_addresses(raw_addresses(t))], ["address"] * 3, known_places(t))


@query("geocodes", _with(PLACES, """
SELECT a.address, ROUND(longitude,6) AS longitude, ROUND(latitude,6) AS latitude FROM (SELECT DISTINCT address FROM enrolled WHERE module='ITI'
 UNION ALL SELECT DISTINCT address FROM enrolled WHERE module='Diploma' UNION ALL SELECT DISTINCT address FROM raw_addr) a LEFT JOIN known USING (address)"""))
def geocodes(t):
    return coded(t).withColumns({c: F.round(c, 6) for c in ["longitude", "latitude"]})


@query("geocode_success", _with(PLACES, """
SELECT COUNT(DISTINCT a.address) AS addresses, COUNT(DISTINCT k.address) AS geocoded FROM (SELECT address FROM enrolled WHERE module IN ('ITI','Diploma')
 UNION ALL SELECT address FROM raw_addr) a LEFT JOIN known k USING (address)"""))
def geocode_success(t):
    return VO.geocoded_count(coded(t))


@described_once
def placed_institutes(t):
    known = known_places(t)
    addresses = VO.institute_addresses(raw_addresses(t))
    codes = VO.geocodes([addresses], ["address"], known)
    return VO.geocoded_institutes(S.institutes(t, "ITI"), addresses, codes)


@query("geocoded_iti_institutes", _with(PLACES, """
SELECT DISTINCT sams_code, ROUND(latitude,6) AS latitude, ROUND(longitude,6) AS longitude FROM inst JOIN raw_addr ON ncvtmis_code='N' || l_suppkey WHERE inst.module='ITI'"""))
def geocoded_iti_institutes(t):
    return placed_institutes(t).withColumns({c: F.round(c, 6) for c in ["longitude", "latitude"]})


@described_once
def located(t):
    """ITI enrolments with both points and the distance."""
    people_rows = S.enrolled(t, "ITI")
    codes = VO.geocodes([people_rows], ["address"], known_places(t))
    return VO.geocoded_enrollments(people_rows, codes, placed_institutes(t))


def vincenty(source: str, lat1: str, lon1: str, lat2: str, lon2: str, to: str, out: str) -> str:
    """CTEs that add kilometres along the ellipsoid to a table, by eight steps of the inverse iteration."""
    f = "(1/298.257223563)"
    parts = f"""sqrt(pow(cu2*sin(lam),2)+pow(cu1*su2-su1*cu2*cos(lam),2)) AS ss, su1*su2+cu1*cu2*cos(lam) AS cs"""
    more = "COALESCE(cu1*cu2*sin(lam)/NULLIF(ss,0),0) AS sa"
    last = f"COALESCE(cs-2*su1*su2/NULLIF(1-sa*sa,0),0) AS cm, {f}/16*(1-sa*sa)*(4+{f}*(4-3*(1-sa*sa))) AS k"
    step = lambda n: f"(SELECT *, {last} FROM (SELECT *, {more} FROM (SELECT *, {parts} FROM g{n})))"
    ctes = [f"""g0 AS MATERIALIZED (SELECT *, sin(a1) AS su1, cos(a1) AS cu1, sin(a2) AS su2, cos(a2) AS cu2, dl AS lam FROM (SELECT *, atan((1-{f})*tan(radians({lat1}))) AS a1, atan((1-{f})*tan(radians({lat2}))) AS a2,
 abs(atan2(sin(radians({lon2})-radians({lon1})),cos(radians({lon2})-radians({lon1})))) AS dl FROM {source}))"""]
    for n in range(8):
        ctes.append(f"g{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (lam, ss, cs, sa, cm, k), dl+(1-k)*{f}*sa*(atan2(ss,cs)+k*ss*(cm+k*cs*(2*cm*cm-1))) AS lam FROM {step(n)})")
    ctes.append(f"""h AS MATERIALIZED (SELECT *, (1-sa*sa)*(1/pow(1-{f},2)-1) AS u FROM {step(8)}),
h2 AS MATERIALIZED (SELECT *, 1+u/16384*(4096+u*(u*(320-175*u)-768)) AS gr, u/1024*(256+u*(u*(74-47*u)-128)) AS be FROM h),
{to} AS (SELECT * EXCLUDE (a1, a2, su1, cu1, su2, cu2, dl, lam, ss, cs, sa, cm, k, u, gr, be), 6378.137*(1-{f})*gr*(atan2(ss,cs)-be*ss*(cm+be/4*(cs*(2*cm*cm-1)-be/6*cm*(4*ss*ss-3)*(4*cm*cm-3)))) AS {out} FROM h2)""")
    return ",\n".join(ctes)


ALONG = """d0 AS (SELECT e.*, k.latitude AS student_lat, k.longitude AS student_long, r.latitude AS institute_lat, r.longitude AS institute_long FROM enrolled e
 LEFT JOIN known k USING (address) LEFT JOIN (SELECT DISTINCT sams_code, latitude, longitude FROM inst JOIN raw_addr ON ncvtmis_code='N' || l_suppkey WHERE inst.module='ITI') r USING (sams_code) WHERE e.module='ITI'),
""" + vincenty("d0", "student_lat", "student_long", "institute_lat", "institute_long", "located", "distance")


@query("geocoded_iti_enrollment", _with(PLACES + ",\n" + ALONG, """
SELECT barcode, ROUND(student_lat,6) AS student_lat, ROUND(institute_long,6) AS institute_long, ROUND(distance,3) AS distance FROM located"""))
def geocoded_iti_enrollment(t):
    return located(t).select("barcode", F.round("student_lat", 6).alias("student_lat"), F.round("institute_long", 6).alias("institute_long"), F.round("distance", 3).alias("distance"))


@query("geocoded_diploma_enrollment", _with(PLACES, """
SELECT barcode, ROUND(latitude,6) AS student_lat, ROUND(longitude,6) AS student_long FROM enrolled LEFT JOIN known USING (address) WHERE module='Diploma'"""))
def geocoded_diploma_enrollment(t):
    people_rows = S.enrolled(t, "Diploma")
    out = VO.geocoded_enrollments(people_rows, VO.geocodes([people_rows], ["address"], known_places(t)))
    return out.select("barcode", F.round("student_lat", 6).alias("student_lat"), F.round("student_long", 6).alias("student_long"))


@query("distance", """
WITH d0 AS (SELECT c_custkey, s_suppkey, 18+c_acctbal/400 AS la, 60+c_nationkey*3 AS lo, s_acctbal/150 AS lb, 10-s_nationkey*7 AS lp FROM customer JOIN supplier ON c_nationkey=s_nationkey),
""" + vincenty("d0", "la", "lo", "lb", "lp", "d1", "km") + """
SELECT c_custkey, s_suppkey, ROUND(km,3) AS km FROM d1""")
def distance(t):
    # A nation has very many pairs, of few rows: all tasks share them, also where suppliers are too many to be broadcast.
    customers, suppliers = t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    pairs = J.join_in_tiles(customers, suppliers, "c_nationkey", "s_nationkey", int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    km = distance_km(18 + F.col("c_acctbal") / 400, 60 + F.col("c_nationkey") * 3, F.col("s_acctbal") / 150, 10 - F.col("s_nationkey") * 7)
    return pairs.select("c_custkey", "s_suppkey", F.round(km, 3).alias("km"))


CATEGORY = """CASE WHEN orphan THEN 'ORPHAN' WHEN gc THEN 'GC' WHEN ph THEN 'PWD' WHEN es THEN 'ES' WHEN ews THEN 'EWS' WHEN social_category IN ('General','OBC/SEBC') THEN 'UR'
 WHEN contains(social_category,'SC') THEN 'SC' WHEN contains(social_category,'ST') THEN 'ST' END"""
MATCHED = f"""scored AS (SELECT m.aadhar_no, m.academic_year, m.exam_name, m.percentage, m.roll_no, e.sams_code, e.reported_branch_or_trade AS trade, e.gender, e.local,
 COALESCE(CAST(e.phase AS INTEGER),-1) AS phase, {CATEGORY} AS social_category, m.highest_qualification_exam_board FROM marks m JOIN enrolled e ON m.aadhar_no=e.aadhar_no AND m.academic_year=e.academic_year WHERE m.module='ITI' AND e.module='ITI'),
above AS (SELECT s.*, c.cutoff, c.institute_name FROM scored s JOIN cutoffs c ON c.module='ITI' AND c.sams_code=s.sams_code AND c.academic_year=s.academic_year AND c.trade=s.trade
 AND c.social_category=s.social_category AND c.gender=s.gender AND CAST(c.selection_stage AS INTEGER)=s.phase AND c.local=s.local AND c.qual=s.exam_name
 QUALIFY ROW_NUMBER() OVER (PARTITION BY s.aadhar_no, s.academic_year, s.sams_code, s.trade, s.social_category, s.gender, s.local, s.exam_name ORDER BY cutoff NULLS FIRST, percentage, roll_no)=1)"""


@described_once
def matched(t):
    return VO.marks_and_cutoffs(S.enrolled(t, "ITI"), S.mark_rows(t, "ITI"), S.cutoff_rows(t))


@query("iti_marks_and_cutoffs", _with(MATCHED, """
SELECT aadhar_no, academic_year, sams_code, trade, social_category, gender, local, ROUND(percentage,4) AS percentage, cutoff FROM above WHERE percentage > cutoff"""))
def iti_marks_and_cutoffs(t):
    return matched(t).select("aadhar_no", "academic_year", "sams_code", "trade", "social_category", "gender", "local", F.round("percentage", 4).alias("percentage"), "cutoff")


@query("iti_vacancies", sql("SELECT * REPLACE (ROUND(vacancy_ratio,6) AS vacancy_ratio) FROM vac"))
def iti_vacancies(t):
    return S.vacancy_rows(t).withColumn("vacancy_ratio", F.round("vacancy_ratio", 6))


# --- HSS and DEG -------------------------------------------------------------------

@query("hss_enrollments", sql("""
SELECT barcode, aadhar_no, academic_year, gender, social_category, district FROM people WHERE module='HSS'"""))
def hss_enrollments(t):
    return H.hss_enrollments(S.students(t), sort=False).select("barcode", "aadhar_no", "academic_year", "gender", "social_category", "district")


@query("hss_clean", sql("""
SELECT barcode, orphan, ph, es, CASE WHEN percentage<=100 THEN percentage END AS percentage, CASE WHEN order_year BETWEEN 1970 AND 2025 THEN CAST(order_year AS DOUBLE) END AS year_of_passing,
 secured_marks, address AS full_address, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag='R') AS compartmental_status FROM people WHERE module='HSS'"""))
def hss_clean(t):
    rows = H.hss_clean(H.hss_enrollments(S.students(t), sort=False))
    return rows.select("barcode", "orphan", "ph", "es", "percentage", "year_of_passing", "secured_marks", "full_address", "compartmental_status")


HSS_OPTIONS = """SELECT barcode, academic_year, CAST(l_linenumber AS VARCHAR) AS "OptionNo", CAST(academic_year AS VARCHAR) AS "Year", inst_id AS "SAMSCode", inst AS "ReportedInstitute",
 stream AS "Stream", inst_district AS "InstituteDistrict", kind AS "TypeofInstitute", status AS "AdmissionStatus", l_suppkey, l_partkey, l_extendedprice FROM people LEFT JOIN lines ON o_orderkey=l_orderkey WHERE module='HSS'"""
# In SQL a missing option list leaves the year null too.
HSS_OPTIONS = HSS_OPTIONS.replace('CAST(academic_year AS VARCHAR) AS "Year"', 'CASE WHEN l_orderkey IS NOT NULL THEN CAST(academic_year AS VARCHAR) END AS "Year"')


@query("hss_applications", sql(f'SELECT * EXCLUDE (l_suppkey, l_partkey, l_extendedprice) FROM ({HSS_OPTIONS})'))
def hss_applications(t):
    return S.hss_options(t).drop("Phase", "InstituteBlock")


@query("hss_applications_enriched", sql("""
SELECT barcode, aadhar_no, academic_year, CAST(COUNT(l_orderkey) OVER (PARTITION BY barcode) AS INTEGER) AS num_applications, inst_id AS sams_code, stream, status AS admission_status
FROM people LEFT JOIN lines ON o_orderkey=l_orderkey WHERE module='HSS'"""))
def hss_applications_enriched(t):
    rows = H.hss_applications_enriched(S.students(t, "HSS"))
    return rows.select("barcode", "aadhar_no", "academic_year", "num_applications", "sams_code", "stream", "admission_status")


SUBJECTS = """people LEFT JOIN (SELECT l_orderkey, p_type, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS fail_mark FROM lines WHERE l_returnflag='R') r ON o_orderkey=r.l_orderkey"""


@query("hss_compartments", sql(f"""
SELECT barcode, academic_year, p_type AS "COMPSubject", fail_mark AS "COMPFailMark", CASE WHEN p_type IS NOT NULL THEN '30' END AS "COMPPassMark" FROM {SUBJECTS} WHERE module='HSS'"""))
def hss_compartments(t):
    return H.hss_compartments(S.students(t, "HSS"))


NOT_NULL_LIST = "(o_orderstatus IN ('F','O') OR o_orderkey IN (SELECT l_orderkey FROM lineitem))"


@query("hss_marks", sql(f"""
SELECT barcode, aadhar_no, academic_year, CAST(percentage AS VARCHAR) IS NOT NULL AS has_percentage, p_type AS comp_subject, fail_mark AS comp_fail_mark FROM {SUBJECTS} WHERE module='HSS' AND {NOT_NULL_LIST}"""))
def hss_marks(t):
    rows = H.hss_marks(S.students(t, "HSS"))
    return rows.select("barcode", "aadhar_no", "academic_year", F.col("percentage").isNotNull().alias("has_percentage"), "comp_subject", "comp_fail_mark")


@query("hss_first_choice_admissions", sql(f"""
SELECT barcode, academic_year, "OptionNo", "SAMSCode", "Stream", "InstituteDistrict", "AdmissionStatus" FROM ({HSS_OPTIONS}) WHERE "OptionNo"='1' AND "AdmissionStatus"='ADMITTED'"""))
def hss_first_choice(t):
    return H.first_choice_admissions(S.hss_options(t)).drop("Phase")


@query("hss_priority_admission", sql(f"""
SELECT barcode, "OptionNo", "SAMSCode", "AdmissionStatus" FROM (SELECT * REPLACE (CASE WHEN rk>0 THEN "OptionNo" END AS "OptionNo", CASE WHEN rk>0 THEN "SAMSCode" END AS "SAMSCode", CASE WHEN rk>0 THEN "AdmissionStatus" END AS "AdmissionStatus") FROM
 (SELECT *, COALESCE(CASE "AdmissionStatus" WHEN 'ADMITTED' THEN 4 WHEN 'SELECTED BUT NOT ADMITTED' THEN 3 WHEN 'TC TAKEN' THEN 2 WHEN 'NOT SELECTED' THEN 1 END,0) AS rk FROM ({HSS_OPTIONS}))
 QUALIFY ROW_NUMBER() OVER (PARTITION BY barcode ORDER BY rk DESC, CAST("OptionNo" AS INTEGER), l_suppkey, l_partkey, l_extendedprice)=1)"""))
def hss_priority(t):
    return H.priority_admission(S.students(t, "HSS")).select("barcode", "OptionNo", "SAMSCode", "AdmissionStatus")


@query("hss_stream_trends", sql(f"""
SELECT "Year", "Stream", COUNT(*) AS student_count FROM ({HSS_OPTIONS}) WHERE "Year" IS NOT NULL GROUP BY 1,2"""))
def hss_stream_trends(t):
    return H.stream_trends(S.students(t, "HSS"))


@query("hss_local_flag", sql(f"""
SELECT barcode, "OptionNo", COALESCE("InstituteDistrict"=district, FALSE) AS local FROM (SELECT barcode, district, CAST(l_linenumber AS VARCHAR) AS "OptionNo", inst_district AS "InstituteDistrict"
FROM people LEFT JOIN lines ON o_orderkey=l_orderkey WHERE module='HSS')"""))
def hss_local_flag(t):
    home = S.people(t).select("barcode", F.concat(F.lit(" "), F.lower("district")).alias("district"))
    return H.with_local_flag(S.hss_options(t).join(home, "barcode")).select("barcode", "OptionNo", "local")


@query("deg_enrollments", sql("""
SELECT barcode, aadhar_no, academic_year, strftime(dob, '%Y-%m-%d') AS dob, orphan, ph, es, replace(replace(student_name,'#',''),'Customer','Customer#') || ', Old Town' AS address,
 CASE p_type WHEN 'ECONOMY' THEN 'B.A.' WHEN 'LARGE' THEN 'Diploma (Civil)' WHEN 'MEDIUM' THEN 'Iti' WHEN 'PROMO' THEN 'Matric' WHEN 'SMALL' THEN 'Chse' END AS highest_qualification
FROM people LEFT JOIN line1 ON o_orderkey=l_orderkey WHERE module='DEG'"""))
def deg_enrollments(t):
    rows = H.deg_enrollments(S.students(t, "DEG"), sort=False)
    return rows.select("barcode", "aadhar_no", "academic_year", F.date_format("dob", "yyyy-MM-dd").alias("dob"), "orphan", "ph", "es", "address", "highest_qualification")


@query("deg_applications", sql(f"""
SELECT barcode, aadhar_no, academic_year, CAST(l_linenumber AS VARCHAR) AS option_no, inst_id AS sams_code, stream, p_type AS subject, status AS admission_status,
 COUNT(l_orderkey) OVER (PARTITION BY academic_year, barcode) AS num_applications FROM people LEFT JOIN lines ON o_orderkey=l_orderkey WHERE module='DEG' AND {NOT_NULL_LIST}"""))
def deg_applications(t):
    rows = H.deg_applications(S.students(t, "DEG"))
    return rows.select("barcode", "aadhar_no", "academic_year", "option_no", "sams_code", "stream", "subject", "admission_status", "num_applications")


@query("deg_marks", sql(f"""
SELECT barcode, aadhar_no, academic_year, p_type AS comp_subject, fail_mark AS comp_fail_mark FROM {SUBJECTS} WHERE module='DEG' AND {NOT_NULL_LIST}"""))
def deg_marks(t):
    return H.deg_marks(S.students(t, "DEG")).select("barcode", "aadhar_no", "academic_year", "comp_subject", "comp_fail_mark")


# --- JSON operators ----------------------------------------------------------------

@query("json_list_explode", sql("""
SELECT stream, COUNT(*) AS n, COUNT(DISTINCT inst_id) AS institutes FROM people LEFT JOIN lines ON o_orderkey=l_orderkey GROUP BY 1"""))
def json_list_explode(t):
    rows = PL.explode_records(S.students(t), "hss_option_details", ["SAMSCode", "Stream"], ["barcode"], lambda f: f)
    return rows.groupBy(F.col("Stream").alias("stream")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("SAMSCode").alias("institutes"))


@query("json_pick", sql("""
SELECT barcode, CAST(f.l_linenumber AS VARCHAR) AS first_option, m.l_suppkey AS arts_institute, CASE WHEN EXISTS (SELECT 1 FROM lines x WHERE x.l_orderkey=o_orderkey AND x.status='ADMITTED') THEN 'Yes' ELSE 'No' END AS admitted,
 CAST((SELECT COUNT(*) FROM lineitem x WHERE x.l_orderkey=o_orderkey) AS INTEGER) AS size, CAST(f.l_linenumber AS INTEGER) AS by_path FROM people LEFT JOIN line1 f ON o_orderkey=f.l_orderkey
 LEFT JOIN (SELECT l_orderkey, inst_id AS l_suppkey FROM lines WHERE stream='Arts' QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, lines.l_suppkey, l_partkey, l_extendedprice)=1) m ON o_orderkey=m.l_orderkey"""))
def json_pick(t):
    records = Y.json_records(F.col("hss_option_details"), ["OptionNo", "SAMSCode", "Stream", "AdmissionStatus"])
    rows = S.students(t).select("barcode", "hss_option_details", records.alias("r"))
    r = F.col("r")
    return rows.select("barcode", Y.first_value(r, "OptionNo").alias("first_option"), Y.value_where(r, "Stream", "Arts", "SAMSCode").alias("arts_institute"),
                       Y.any_equal(r, "AdmissionStatus", "ADMITTED").alias("admitted"), Y.list_size(r).alias("size"),
                       Y.json_path(F.col("hss_option_details"), "$[0].OptionNo", "int").alias("by_path"))


@query("json_sizes", _with("""s AS (SELECT academic_year, o_orderkey, COUNT(l_orderkey) AS k FROM people LEFT JOIN lineitem ON o_orderkey=l_orderkey GROUP BY 1,2)""",
"SELECT academic_year, COUNT(*) FILTER (k>0) AS with_options, COUNT(*) FILTER (k=0) AS without_options, CAST(SUM(k) AS BIGINT) AS options FROM s GROUP BY 1"))
def json_sizes(t):
    return PL.option_sizes(S.students(t), "option_data", ["academic_year"])


@query("json_map_long", """
SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS amount FROM events""")
def json_map_long(t):
    return PL.map_to_long(t.events, "props", ["event_id"], "name", "amount")


@query("json_map_long_pieces", """
SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS amount FROM events""")
def json_map_long_pieces(t):
    return PL.map_to_long(t.events, "props", ["event_id"], "name", "amount", pieces=4)


@query("json_rename_keys", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_rename_keys(t):
    parsed = Y.rename_keys(Y.json_object(F.replace("props", F.lit('"k"'), F.lit('"K"'))))
    return t.events.select("event_id", F.try_element_at(parsed, F.lit("k")).alias("k"))


# --- scalars -----------------------------------------------------------------------

@query("scalar_dates", """
SELECT o_orderkey, d AS iso, d AS day_first, d AS long_form, year(o_orderdate) || '-01-01' AS year_only, CAST(NULL AS VARCHAR) AS broken, TRUE AS valid,
 CASE WHEN year(o_orderdate) BETWEEN 1970 AND 2025 THEN CAST(year(o_orderdate) AS DOUBLE) END AS passing FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""")
def scalar_dates(t):
    form = lambda f: F.date_format("o_orderdate", f)
    day = lambda c: c.cast("date").cast("string")
    return t.orders.select(
        "o_orderkey", day(V.to_timestamp_or_null(form("yyyy-MM-dd"))).alias("iso"), day(V.to_date_day_first(form("dd/MM/yyyy"))).alias("day_first"),
        day(V.to_date_day_first(form("d MMMM yyyy"))).alias("long_form"), day(V.to_date_day_first(form("yyyy"))).alias("year_only"),
        day(V.to_timestamp_or_null(form("'day' dd"))).alias("broken"), V.checked_date(form("MM/dd/yyyy"))["ok"].alias("valid"),
        V.passing_year(form("yyyy")).alias("passing"))


@query("scalar_text", """
SELECT p_partkey, upper(substr(p_type,1,1)) || lower(substr(p_type,2)) AS titled, lower(replace(p_name,' ','_')) AS normal, replace(p_name,' ','') AS fused,
 'Brand # ' || substr(p_brand,7) AS spaced, p_name || ', X, ' || p_type || ',  ' || p_size AS line, '00' || substr(p_brand,2) AS roll, lower(split_part(p_name,' ',1)) AS word, 'A & B' AS plain
FROM part""")
def scalar_text(t):
    none = F.lit(None).cast("string")
    return t.part.select(
        "p_partkey", X.title(F.col("p_type")).alias("titled"), X.normalise_text(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))).alias("normal"),
        F.replace("p_name", F.lit(" "), F.lit("")).alias("fused"), F.regexp_replace("p_brand", "#", " # ").alias("spaced"),
        X.address_line(F.concat("p_name", F.lit(", rest")), F.lit("X"), F.col("p_type"), F.lit(""), F.col("p_size")).alias("line"),
        X.roll_tail(F.col("p_brand")).alias("roll"), X.first_word_lower(F.upper("p_name")).alias("word"), X.tidy_name(F.concat(F.lit(" A &amp;  B"), F.coalesce(none, F.lit(" ")))).alias("plain"))


@query("scalar_numbers", """
SELECT l_orderkey, l_partkey, ROUND(l_quantity/50*100, 4) AS pct, CASE WHEN l_quantity*3<=100 THEN l_quantity*3 END AS ranged, CAST(NULL AS DOUBLE) AS bad,
 ROUND(CASE WHEN l_linenumber=3 THEN l_quantity*9.5 ELSE l_quantity/(CASE WHEN l_linenumber=3 THEN 10 ELSE 50 END)*100 END, 4) AS cgpa,
 CASE WHEN l_linenumber=1 THEN 'Fresh graduate' WHEN l_linenumber<=4 THEN '1-3 years' ELSE '> 3 years' END AS gap, printf('%.1f', l_discount) AS shown,
 CASE WHEN l_linenumber > 4 THEN l_linenumber::DOUBLE END AS odd FROM lineitem""")
def scalar_numbers(t):
    total = F.when(F.col("l_linenumber") == 3, "10").otherwise("50")
    quantity = F.col("l_quantity").cast("string")
    odd = F.array(F.lit("5d"), F.lit("0x1p3"), F.lit("NaN"), F.lit("Infinity"), F.concat(F.col("l_linenumber").cast("string"), F.lit(".0e0 ")))
    return t.lineitem.select(
        "l_orderkey", "l_partkey", F.round(V.marks_percentage(quantity, F.lit("50")), 4).alias("pct"),
        V.percentage_in_range((F.col("l_quantity") * 3).cast("string")).alias("ranged"), V.number(F.concat(F.lit("x"), quantity)).alias("bad"),
        F.round(V.grade_point_percentage(quantity, total), 4).alias("cgpa"), V.gap_class(F.col("l_linenumber") - 1).alias("gap"),
        V.fixed_decimals(F.col("l_discount"), 1).alias("shown"),
        V.number(F.concat(F.lit(" "), F.element_at(odd, F.least("l_linenumber", F.lit(5))))).alias("odd"))


@query("scalar_flags", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS loose,
 CASE o_orderstatus WHEN 'F' THEN 'ADMITTED' END AS present FROM orders""")
def scalar_flags(t):
    from rollbook.functions.nulls import null_school, null_tokens

    text = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No").otherwise("n/a")
    loose = F.concat(F.lit(" "), F.upper(text))
    status = F.when(F.col("o_orderstatus") == "F", "ADMITTED").when(F.col("o_orderstatus") == "O", "  ").otherwise(" -- ")
    return t.orders.select("o_orderkey", V.yes_no(text).alias("flag"), V.yes_no_any_case(loose).alias("loose"), null_tokens(null_school(status)).alias("present"))


@query("qualification_levels", sql("""
SELECT barcode, CASE p_type WHEN 'ECONOMY' THEN 'Graduate and above' WHEN 'LARGE' THEN 'Diploma' WHEN 'MEDIUM' THEN 'ITI' WHEN 'PROMO' THEN '10th' WHEN 'SMALL' THEN '12th' END AS level,
 CASE WHEN bool_or(l_returnflag='N') OVER w THEN '12th' WHEN bool_or(l_returnflag='R') OVER w THEN 'ITI' ELSE CASE WHEN module='ITI' THEN '10th' ELSE '10th' END END AS best
FROM people JOIN lines ON o_orderkey=l_orderkey WINDOW w AS (PARTITION BY l_orderkey) QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice)=1"""))
def qualification_levels(t):
    exams = F.transform(Y.json_records(F.col("mark_data"), ["ExamName"]), lambda m: m["ExamName"])
    rows = S.students(t).where("sams_code is not null")
    return rows.select("barcode", C.standard_qualification(F.col("highest_qualification")).alias("level"), C.highest_exam(exams).alias("best"))


@query("reservation_category", sql(f"SELECT barcode, {CATEGORY} AS category, CASE WHEN {CATEGORY} IN ('SC','ST','UR') THEN {CATEGORY} ELSE 'Other' END AS coarse FROM people"))
def reservation_category(t):
    flag = lambda c: V.yes_no(F.col(c))
    category = C.reservation_category(F.col("social_category"), flag("orphan"), flag("gc"), F.col("ph"), flag("es"), flag("ews"))
    return S.people(t).select("barcode", category.alias("category"), C.coarse_category(category).alias("coarse"))


@query("coarse_boards", sql("""
SELECT CASE WHEN highest_qualification_exam_board='BSE, ODISHA' THEN 'BSE Odisha' ELSE 'CBSE' END AS board, COUNT(*) AS n FROM marks WHERE module='ITI' GROUP BY 1"""))
def coarse_boards(t):
    return A.count_by(S.mark_rows(t, "ITI").withColumn("board", C.coarse_board(F.col("highest_qualification_exam_board"))), ["board"])


# --- identity ----------------------------------------------------------------------

TEST_KEY = "0123456789abcdef0123456789abcdef"


@query("student_key", sql("""
SELECT barcode, lower(student_name) || '_' || (year(p1.l_shipdate)-p1.l_linenumber+1) || '_' || dob || '_' || CASE WHEN length(CAST(p1.l_partkey AS VARCHAR))=9 OR p1.l_linestatus<>'O' THEN lower(CAST(p1.l_partkey AS VARCHAR)) ELSE 'NA' END || '_'
 || CASE WHEN p1.l_linestatus='O' THEN 'bse, odisha' ELSE 'cbse' END || '_annual' AS student_key, CAST(p1.l_partkey AS VARCHAR) AS roll_no_original FROM people JOIN line1 p1 ON o_orderkey=l_orderkey"""))
def student_key(t):
    rows = ID.marksheet_identity(S.students(t).where("sams_code is not null"))
    secret = F.base64(F.aes_encrypt(F.col("roll_no"), F.lit(TEST_KEY), F.lit("ECB"), F.lit("PKCS")))
    keyed = ID.with_student_key(rows.withColumn("roll_no", secret), TEST_KEY)
    return keyed.select("barcode", "student_key", "roll_no_original")


UNIQUE_KEYS = """keyed AS (SELECT module, academic_year, aadhar_no, student_name || '-' || dob || '-' || (year(l_shipdate)-l_linenumber+1) || '-' || CASE WHEN l_linestatus='O' THEN 'BSE, ODISHA' ELSE 'CBSE' END
 || '-Annual-' || l_partkey AS unique_key FROM people LEFT JOIN lines ON o_orderkey=l_orderkey WHERE module IN ('ITI','Diploma','PDIS'))"""


@query("marksheet_keys", _with(UNIQUE_KEYS, "SELECT academic_year, COUNT(DISTINCT aadhar_no) AS persons, COUNT(DISTINCT unique_key) AS keys, COUNT(*) AS n, COUNT(*)-COUNT(unique_key) AS incomplete FROM keyed GROUP BY 1"))
def marksheet_keys(t):
    return ID.marksheet_keys(S.students(t)).groupBy("academic_year").agg(
        F.count_distinct("aadhar_no").alias("persons"), F.count_distinct("unique_key").alias("keys"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("unique_key").isNull()).alias("incomplete"))


OVERLAP = """overlap AS (SELECT aadhar_no AS unique_key, CAST(MAX(CASE WHEN module='ITI' THEN 1 ELSE 0 END) AS INTEGER) AS applied_iti, CAST(MAX(CASE WHEN module='Diploma' THEN 1 ELSE 0 END) AS INTEGER) AS applied_diploma,
 CAST(MAX(CASE WHEN module='HSS' THEN 1 ELSE 0 END) AS INTEGER) AS applied_hss, CAST(MAX(CASE WHEN module='DEG' THEN 1 ELSE 0 END) AS INTEGER) AS applied_degree FROM people GROUP BY 1)"""


@described_once
def overlap(t):
    return ID.module_overlap(S.people(t).withColumnRenamed("aadhar_no", "unique_key"))


@query("module_overlap", _with(OVERLAP, "SELECT *, CAST(applied_iti+applied_diploma+applied_hss+applied_degree AS INTEGER) AS total_applied FROM overlap"))
def module_overlap(t):
    return overlap(t)


@query("overlap_count", _with(OVERLAP, "SELECT COUNT(*) AS keys FROM overlap WHERE applied_diploma=1 AND applied_hss=1"))
def overlap_count(t):
    return ID.overlap_count(overlap(t), "applied_diploma", "applied_hss")


# --- trainees ----------------------------------------------------------------------

@described_once
def trainees(t):
    """Line items as trainees: the order's year of admission, shipping results as examination results."""
    rows = S.lines(t).join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("o_year")), "l_orderkey")
    roll = F.concat(F.lit("'"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"))
    admitted = rows.select((F.col("o_year") + 22).alias("year"), roll.alias("Roll_Num"), F.concat(F.lit("N"), "l_suppkey").alias("ITI_Code"),
                           F.col("p_brand").alias("Trade_Name"), F.when(F.col("l_tax") < 0.04, "Female").otherwise("Male").alias("Gender"))
    sheets = rows.where("l_returnflag <> 'N'").select(
        roll.alias("Roll No"), F.when(F.col("l_linestatus") == "O", "Pass with merit").otherwise("Fail").alias("Overall Result"),
        (F.col("o_year") + 22).alias("year"), F.when(F.col("l_returnflag") == "A", 1).otherwise(2).alias("exam_year"))
    kinds = t.supplier.select(F.concat(F.lit("N"), "s_suppkey").alias("ncvtmis_code"), F.when(F.col("s_acctbal") >= 5000, "Govt.").otherwise("Pvt.").alias("type_of_institute"))
    trades = t.part.select(F.col("p_brand").alias("reported_branch_or_trade"), F.when(F.col("p_brand") < "Brand#2", "1 Year").otherwise("2 Years").alias("course_period"))
    combined = TR.combine(TR.clean_admitted(admitted), TR.clean_results(sheets))
    return TR.with_outcome(combined, kinds, trades)


TRAINEES = """tr0 AS (SELECT CAST(year(o_orderdate)+22 AS INTEGER) AS year, l_orderkey || '-' || l_partkey AS roll_num, kind AS type_of_institute,
 CASE WHEN year(o_orderdate)+22=2018 THEN NULL WHEN p_brand<'Brand#2' THEN '1 Year' ELSE '2 Years' END AS course_period, CASE WHEN l_tax<0.04 THEN 'Female' ELSE 'Male' END AS gender, l_returnflag, l_linestatus FROM lines JOIN orders ON l_orderkey=o_orderkey),
res AS (SELECT year, roll_num, MIN(CASE WHEN l_returnflag='A' THEN CASE WHEN l_linestatus='O' THEN 'pass' ELSE 'fail' END END) AS y1, MIN(CASE WHEN l_returnflag='R' THEN CASE WHEN l_linestatus='O' THEN 'pass' ELSE 'fail' END END) AS y2
 FROM tr0 WHERE l_returnflag<>'N' GROUP BY 1,2),
tr AS (SELECT tr0.*, y1, y2, COALESCE((course_period='1 Year' AND y1 IS NULL) OR (course_period='2 Years' AND y2 IS NULL), FALSE) AS dropout,
 COALESCE((course_period='1 Year' AND y1='pass') OR (course_period='2 Years' AND y2='pass'), FALSE) AS passed FROM tr0 LEFT JOIN res USING (year, roll_num))"""


@query("trainee_outcomes", _with(TRAINEES, """SELECT year, gender, type_of_institute, COUNT(*) AS n, COUNT(DISTINCT roll_num) AS rolls, COUNT(y1) AS y1, COUNT(y2) AS y2,
 COUNT(*) FILTER (dropout) AS dropouts, COUNT(*) FILTER (passed) AS passes FROM tr GROUP BY 1,2,3"""))
def trainee_outcomes(t):
    return trainees(t).groupBy("year", "gender", "type_of_institute").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("roll_num").alias("rolls"), F.count("overall_result_y1").alias("y1"), F.count("overall_result_y2").alias("y2"),
        *A.count_where(dropouts=F.col("dropout"), passes=F.col("passed")))


# --- landing -----------------------------------------------------------------------

@query("dedupe_rejects", """
WITH b AS (SELECT o_orderkey AS id, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, CASE WHEN o_totalprice<480000 THEN o_orderstatus END AS status, CASE WHEN o_totalprice>1200 THEN o_orderpriority END AS priority FROM orders
 UNION ALL SELECT o_orderkey+100000000, o_custkey, CAST(year(o_orderdate) AS INTEGER), o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus='P'),
e AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderstatus AS status FROM orders WHERE o_totalprice>495000),
m AS (SELECT *, CASE WHEN priority IS NULL THEN 'missing priority' END AS miss FROM b),
r AS (SELECT m.*, ROW_NUMBER() OVER (PARTITION BY o_custkey, yr, status, miss IS NULL ORDER BY id) AS rn, e.status IS NOT NULL AS known FROM m LEFT JOIN e USING (o_custkey, yr, status))
SELECT COALESCE(miss, CASE WHEN status IS NULL THEN 'accepted' WHEN known THEN 'already loaded' WHEN rn>1 THEN 'duplicate in batch' ELSE 'accepted' END) AS outcome, COUNT(*) AS n, CAST(SUM(id) AS BIGINT) AS ids FROM r GROUP BY 1""")
def dedupe_rejects(t):
    yr = F.year("o_orderdate").alias("yr")
    first = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey", yr, F.when(F.col("o_totalprice") < 480000, F.col("o_orderstatus")).alias("status"),
                            F.when(F.col("o_totalprice") > 1200, F.col("o_orderpriority")).alias("priority"))
    copies = t.orders.where("o_orderstatus = 'P'").select((F.col("o_orderkey") + 100000000).alias("id"), "o_custkey", yr, F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    existing = t.orders.where("o_totalprice > 495000").select("o_custkey", yr, F.col("o_orderstatus").alias("status"))
    accepted, rejected = L.split_new(first.unionByName(copies), ["o_custkey", "yr", "status"], ["priority"], "id", existing)
    kept = accepted.withColumns({"outcome": F.lit("accepted"), "copies": F.lit(1).cast("long")})
    both = kept.unionByName(rejected.withColumnRenamed("reason", "outcome"))
    return both.groupBy("outcome").agg(F.sum("copies").alias("n"), F.sum(F.col("id") * F.col("copies")).alias("ids"))


@query("incremental_status", """
WITH x AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderstatus AS kind, COUNT(*) AS expected FROM orders GROUP BY 1,2),
l AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CASE WHEN o_orderpriority='5-LOW' AND o_orderstatus='F' THEN 'O' ELSE o_orderstatus END AS kind, COUNT(*) AS loaded FROM orders GROUP BY 1,2)
SELECT yr, kind, expected, COALESCE(loaded,0) AS loaded, CASE WHEN COALESCE(loaded,0)>expected THEN 'excess' WHEN loaded=expected THEN 'done' ELSE 'missing' END AS status FROM x LEFT JOIN l USING (yr, kind)""")
def incremental_status(t):
    yr = F.year("o_orderdate").alias("yr")
    pages = t.orders.groupBy(yr, F.col("o_orderstatus").alias("kind")).agg(F.count(F.lit(1)).alias("records"))
    moved = F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"), "O").otherwise(F.col("o_orderstatus"))
    # Orders land in two batches; the status comes from what each batch has counted.
    from rollbook.streaming import land

    work, rows = _scratch(t, "landing-status"), t.orders.select("o_orderkey", yr, moved.alias("kind"))
    for batch in (0, 1):
        land.land_batch(rows.where(F.pmod("o_orderkey", F.lit(2)) == batch), batch, f"{work}/table", ["o_orderkey", "yr", "kind"], [], "o_orderkey", ["yr", "kind"])
    return L.completeness(land.landed_counts(t.spark, f"{work}/table", ["yr", "kind"]), L.expected_counts(pages, ["yr", "kind"]), ["yr", "kind"], counted="count")


@query("without_slice", sql("SELECT module, academic_year, COUNT(*) AS n FROM people WHERE NOT (module='ITI' AND academic_year=2020) GROUP BY 1,2"))
def without_slice(t):
    return A.count_by(L.without_slice(S.people(t), "ITI", 2020), ["module", "academic_year"])


@query("missing_log", sql("""
SELECT 'ITI' AS module, 2020 AS academic_year, (SELECT COUNT(*) FROM people WHERE module='ITI' AND academic_year=2020) AS records, variable, missing FROM (
 SELECT 'phase' AS variable, COUNT(*) FILTER (phase IS NULL) AS missing FROM people WHERE module='ITI' AND academic_year=2020
 UNION ALL SELECT 'gc', COUNT(*) FILTER (gc IS NULL) FROM people WHERE module='ITI' AND academic_year=2020 UNION ALL SELECT 'had_two_year_full_time_work_exp_after_tenth', COUNT(*) FROM people WHERE module='ITI' AND academic_year=2020) WHERE missing>0"""))
def missing_log(t):
    rows = S.people(t).where("module = 'ITI' and academic_year = 2020")
    return L.missing_log(rows, ["phase", "gc", "gender", "had_two_year_full_time_work_exp_after_tenth"])


@query("normalise_records", sql("SELECT barcode, aadhar_no, student_name, gender, 'HSS' AS module, 2023 AS academic_year, 0 AS year, CAST(NULL AS VARCHAR) AS roll_no FROM people"))
def normalise_records(t):
    raw = S.people(t).select(F.col("barcode").alias("Barcode"), F.col("aadhar_no").alias("AadharNo"), F.col("student_name").alias("StudentName"), F.col("gender").alias("Gender"), F.lit("x").alias("Unknown"))
    return L.normalise_records(raw, "HSS", 2023).select("barcode", "aadhar_no", "student_name", "gender", "module", "academic_year", "year", "roll_no")


@query("stream_landing", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_landing(t):
    """Events written as files, landed by two streaming runs, the second over grown input."""
    from rollbook.session import shared_folder
    from rollbook.streaming import land

    work = shared_folder(t.spark, "landing")
    typed = lambda df: df.withColumn("ts", F.col("ts").cast("timestamp"))
    text = t.events.withColumn("ts", F.col("ts").cast("string"))
    fields = text.schema
    for half in ("event_type in ('click', 'view')", "event_type not in ('click', 'view')"):
        # Copies arrive again with the second half and must not be landed twice.
        text.where(half).unionByName(text.where("event_type = 'click'")).write.mode("append").json(f"{work}/files")
        land.land_files(
            t.spark, f"{work}/files", fields, f"{work}/table", f"{work}/checkpoint", ["event_id"], ["event_id"], "ts", ["event_type"], prepare=typed
        ).awaitTermination()
    return land.landed(t.spark, f"{work}/table").select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("landing_log", """
SELECT batch, records, SUM(records) OVER (ORDER BY batch)::BIGINT AS total FROM (SELECT 0::BIGINT AS batch, COUNT(*) AS records FROM orders WHERE o_orderkey % 2 = 0
 UNION ALL SELECT 1, COUNT(*) FROM orders WHERE o_orderkey % 2 = 1)""")
def landing_log(t):
    """Orders landed as lines of mixed spellings in two batches; the log of both."""
    from rollbook.sources import landing as L
    from rollbook.streaming import land

    work = _scratch(t, "landing-log")
    for batch in (0, 1):
        land.land_batch(_order_lines(t, batch), batch, f"{work}/table", ["barcode", "module", "academic_year"], ["barcode"], "student_name",
                        ["module", "academic_year"], lambda df: L.normalise_lines(df, "HSS", 2023))
    return land.load_log(t.spark, f"{work}/table").select(F.col("batch").cast("long").alias("batch"), "records", F.col("total"))


def _order_lines(t, half: int):
    """Half of the orders as records, one spelling of the option field in each half."""
    option = ("HssOptionDetails", "HSSOptionDetails")[half]
    fields = F.struct(F.col("o_orderkey").cast("string").alias("Barcode"), F.concat(F.lit("n"), "o_custkey").alias("StudentName"), F.col("o_orderstatus").alias(option))
    return t.orders.where(F.pmod("o_orderkey", F.lit(2)) == half).select(F.to_json(fields).alias("value"))


@query("landed_spellings", "SELECT CAST(o_orderkey AS VARCHAR) AS barcode, o_orderstatus AS hss_option_details FROM orders")
def landed_spellings(t):
    """Lines with two spellings of a field, landed together; none is lost."""
    from rollbook.sources import landing as L
    from rollbook.streaming import land

    work = _scratch(t, "landing-spellings")
    lines = _order_lines(t, 0).unionByName(_order_lines(t, 1))
    land.land_batch(lines, 0, f"{work}/table", ["barcode", "module", "academic_year"], ["barcode"], "student_name",
                    ["module", "academic_year"], lambda df: L.normalise_lines(df, "HSS", 2023))
    return land.landed(t.spark, f"{work}/table").select("barcode", "hss_option_details")


# --- reading and writing ---------------------------------------------------------------

def _scratch(t, purpose):
    from rollbook.session import shared_folder

    return shared_folder(t.spark, purpose)


@query("save_load_formats", """
SELECT 'parquet' AS fmt, c_custkey, c_name FROM customer UNION ALL SELECT 'csv', c_custkey, c_name FROM customer UNION ALL SELECT 'json', c_custkey, c_name FROM customer""")
def save_load_formats(t):
    from rollbook.sources import catalog as K

    folder = _scratch(t, "formats")
    rows = t.customer.select("c_custkey", "c_name")
    back = None
    for fmt in K.FORMATS:
        target = K.Dataset(f"customers_{fmt}", fmt, f"{folder}/{fmt}", "interim")
        K.save(rows, target)
        read = K.load(t.spark, target, rows.schema).select(F.lit(fmt).alias("fmt"), "c_custkey", "c_name")
        back = read if back is None else back.unionByName(read)
    return back


@query("tagged_files", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(NULL AS INTEGER) AS exam_year FROM orders")
def tagged_files(t):
    """Files in folders named by year, read back as one table with the year taken from the paths."""
    from rollbook.sources.catalog import read_tagged_files

    folder = _scratch(t, "tagged")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("Sheet"))
    rows.write.option("header", True).partitionBy("Sheet").csv(folder)
    tags = {"year": r"Sheet=(\d{4})", "exam_year": r"Year(\d)"}
    files = read_tagged_files(t.spark, f"{folder}/Sheet=*", tags, "o_orderkey string", whole_path=True)
    return files.select("o_orderkey", "year", "exam_year")


@query("write_by_year", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS academic_year FROM orders")
def write_by_year(t):
    from rollbook.sources.catalog import write_by_year as write

    folder = _scratch(t, "years")
    write(t.orders.select("o_orderkey", F.year("o_orderdate").alias("academic_year")), folder)
    return t.spark.read.parquet(folder)


@query("publish_tables", "SELECT n_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1")
def publish_tables(t):
    from rollbook.sources.catalog import publish

    counts = A.count_by(t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")), ["n_name"])
    return t.spark.read.parquet(*publish({"by_nation": counts}, _scratch(t, "tables")))


@query("scan_module", sql("SELECT barcode, academic_year FROM people WHERE module='DEG' AND academic_year BETWEEN 2019 AND 2021"))
def scan_module(t):
    from rollbook.sources.catalog import scan_module as scan

    folder = _scratch(t, "students")
    S.people(t).select("barcode", "academic_year", "module").write.partitionBy("module").parquet(folder)
    return scan(t.spark.read.parquet(folder), "DEG", (2019, 2021)).select("barcode", "academic_year")


@query("sql_function", "SELECT p_partkey, upper(p_type) || '/' || p_brand AS label FROM part")
def sql_function(t):
    from rollbook.sources.catalog import sql_over

    body = {"part_label(kind STRING, brand STRING) RETURNS STRING": "concat(upper(kind), '/', brand)"}
    return sql_over(t.spark, {"parts_view": t.part}, "SELECT p_partkey, part_label(p_type, p_brand) AS label FROM parts_view", body)


@query("sql_unnest", sql("SELECT barcode, CAST(l_linenumber AS VARCHAR) AS option_no FROM people LEFT JOIN lineitem ON o_orderkey=l_orderkey WHERE module='ITI'"))
def sql_unnest(t):
    """Lateral unnest in SQL, applications without options kept."""
    from rollbook.sources.catalog import sql_over

    text = "SELECT barcode, o.Option_No AS option_no FROM s LATERAL VIEW OUTER explode(from_json(option_data, 'array<struct<Option_No string>>')) x AS o"
    return sql_over(t.spark, {"s": S.students(t, "ITI")}, text)
