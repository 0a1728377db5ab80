"""Report tables over the stand-in records."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import standins as S
from queries.base import described_once, query
from queries.datasets import ALONG, MATCHED, PLACES, TRAINEES, UNIQUE_KEYS, _with, located, matched, trainees
from rollbook.functions import payload as Y, text as X
from rollbook.operators import aggregate as A
from rollbook.plans import demand_tables as DM, district_tables as DT, enrollment_tables as ET, higher as H, identity as ID
from rollbook.plans import school_tables as ST, trainees as TR, vocational as VO

sql = S.sql
ITI, DIPLOMA = "enrolled WHERE module='ITI'", "enrolled WHERE module='Diploma'"
STATS = """round_even(AVG(v),1) AS "Mean", round_even(STDDEV_SAMP(v),1) AS "Std", round_even(quantile_cont(v,0.25),1) AS "25th",
 round_even(quantile_cont(v,0.5),1) AS "Median", round_even(quantile_cont(v,0.75),1) AS "75th", COUNT(v) AS "Count" """


def rounded(df, digits: int, *columns: str):
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def iti(t):
    return S.enrolled(t, "ITI")


def diploma(t):
    return S.enrolled(t, "Diploma")


# --- enrolment over time -------------------------------------------------------------

@query("iti_enrollments_over_time", sql(f"""SELECT academic_year AS "Year", COUNT(DISTINCT aadhar_no) AS "Num. students" FROM {ITI} GROUP BY 1"""))
def iti_enrollments_over_time(t):
    return ET.enrollments_over_time(iti(t))


@query("combined_enrollments_over_time", sql(f"""
SELECT * FROM (SELECT academic_year AS "Year", COUNT(DISTINCT aadhar_no) AS "ITI" FROM {ITI} GROUP BY 1) FULL OUTER JOIN
 (SELECT academic_year AS "Year", COUNT(DISTINCT aadhar_no) AS "Diploma" FROM {DIPLOMA} GROUP BY 1) USING ("Year") WHERE "Year" > 2017"""))
def combined_enrollments_over_time(t):
    return ET.combined_over_time(ET.enrollments_over_time(iti(t)), ET.enrollments_over_time(diploma(t)), ET.STUDENTS)


@query("iti_enrollments_over_time_by_type", sql(f"""
SELECT academic_year AS "Year", round_even(p::DOUBLE/(p+g)*100,1) AS "Pvt (%)", round_even(g::DOUBLE/(p+g)*100,1) AS "Govt (%)", p+g AS "Num. students" FROM
 (SELECT academic_year, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Govt.') AS g, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Pvt.') AS p FROM {ITI} AND academic_year>2017 GROUP BY 1)"""))
def iti_enrollments_over_time_by_type(t):
    return ET.enrollments_by_type(iti(t))


@query("pipeline_pct", """
WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) FILTER (o_orderpriority='1-URGENT') AS a, COUNT(*) FILTER (o_orderpriority='2-HIGH') AS b,
 COUNT(*) FILTER (o_orderpriority='3-MEDIUM') AS c, COUNT(*) FILTER (o_orderpriority='5-LOW') AS d FROM orders GROUP BY 1)
SELECT yr, round_even(a::DOUBLE/(a+b+c+d)*100,1) AS "11th std. admitted (%)", round_even(b::DOUBLE/(a+b+c+d)*100,1) AS "ITI admitted (%)",
 round_even(c::DOUBLE/(a+b+c+d)*100,1) AS "Diploma admitted (%)", round_even(d::DOUBLE/(a+b+c+d)*100,1) AS "Assumed Dropouts (%)" FROM c""")
def pipeline_pct(t):
    rows = t.orders.withColumn("yr", F.year("o_orderdate"))
    cells = {n: F.col("o_orderpriority") == p for n, p in {"a": "1-URGENT", "b": "2-HIGH", "c": "3-MEDIUM", "d": "5-LOW"}.items()}
    return ET.pipeline_shares(rows.groupBy("yr").agg(*A.count_where(**cells)))


@query("iti_institutes_over_time", sql("""SELECT academic_year AS "Year", COUNT(DISTINCT sams_code) AS "Num. institutes" FROM strength WHERE module='ITI' GROUP BY 1"""))
def iti_institutes_over_time(t):
    return ET.institutes_over_time(S.strength(t, "ITI"))


@query("combined_institutes_over_time", sql("""
SELECT academic_year AS "Year", COUNT(DISTINCT sams_code) FILTER (module='ITI') AS "ITI", COUNT(DISTINCT sams_code) FILTER (module='Diploma') AS "Diploma" FROM strength GROUP BY 1 HAVING academic_year>2017"""))
def combined_institutes_over_time(t):
    return ET.combined_over_time(ET.institutes_over_time(S.strength(t, "ITI")), ET.institutes_over_time(S.strength(t, "Diploma")), ET.INSTITUTES)


KIND_ROWS = "(SELECT DISTINCT s.academic_year, s.sams_code, k.type_of_institute FROM strength s LEFT JOIN (SELECT DISTINCT sams_code, type_of_institute FROM enrolled WHERE module='ITI') k USING (sams_code) WHERE s.module='ITI')"


@query("iti_enrollment_institutes_over_time", sql(f"""
SELECT "Year", COALESCE(g,0) AS "Govt._Num. students", COALESCE(p,0) AS "Pvt._Num. students", COALESCE(g+p,0) AS "Total_Num. students", COALESCE(ig,0) AS "Govt._Num. institutes",
 COALESCE(ip,0) AS "Pvt._Num. institutes", COALESCE(ig+ip,0) AS "Total_Num. institutes" FROM
 (SELECT academic_year AS "Year", COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Govt.') AS g, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Pvt.') AS p FROM {ITI} GROUP BY 1) FULL OUTER JOIN
 (SELECT academic_year AS "Year", COUNT(DISTINCT sams_code) FILTER (type_of_institute='Govt.') AS ig, COUNT(DISTINCT sams_code) FILTER (type_of_institute='Pvt.') AS ip FROM {KIND_ROWS} GROUP BY 1) USING ("Year")"""))
def iti_enrollment_institutes_over_time(t):
    return ET.enrollments_and_institutes(iti(t), S.strength(t, "ITI"))


@query("iti_institutes_over_time_by_type", sql(f"""
SELECT academic_year AS "Year", g AS "Govt.", p AS "Pvt.", round_even(p::DOUBLE/(p+g)*100,1) AS "Pvt (%)", round_even(g::DOUBLE/(p+g)*100,1) AS "Govt (%)", p+g AS "Num. institutes" FROM
 (SELECT academic_year, COUNT(DISTINCT sams_code) FILTER (type_of_institute='Govt.') AS g, COUNT(DISTINCT sams_code) FILTER (type_of_institute='Pvt.') AS p FROM {KIND_ROWS} GROUP BY 1)"""))
def iti_institutes_over_time_by_type(t):
    return ET.institutes_by_type(S.strength(t, "ITI"), iti(t))


@query("gap_between_10th_graduation_and_enrollment_iti", sql("""
SELECT "Years since graduation", COUNT(*) AS "Num. students", round_even(COUNT(*)::DOUBLE/SUM(COUNT(*)) OVER ()*100,2) AS "Share (%)" FROM
 (SELECT CASE WHEN year(date_of_application)-CAST(year_of_passing AS INTEGER)=0 THEN 'Fresh graduate' WHEN year(date_of_application)-CAST(year_of_passing AS INTEGER)<=3 THEN '1-3 years' ELSE '> 3 years' END AS "Years since graduation"
 FROM enrolled e JOIN marks m USING (aadhar_no, academic_year) WHERE e.module='ITI' AND m.module='ITI') GROUP BY 1"""))
def gap_exhibit(t):
    return ET.graduation_gap(iti(t), S.mark_rows(t, "ITI"))


TRADES = f"""tg AS (SELECT academic_year, gender, reported_branch_or_trade AS trade, COUNT(DISTINCT aadhar_no) AS n FROM {ITI} GROUP BY 1,2,3),
ts AS (SELECT *, n::DOUBLE/SUM(n) OVER (PARTITION BY academic_year, gender) AS share FROM tg)"""
for _gender in ("Male", "Female"):
    @query(f"top_5_trades_{_gender.lower()}_over_time", _with(TRADES, f"""
    SELECT academic_year AS "Year", trade AS "Trade", n AS "Num. students", ROUND(share,6) AS "Share" FROM ts WHERE gender='{_gender}'
    QUALIFY ROW_NUMBER() OVER (PARTITION BY academic_year ORDER BY n DESC, trade)<=5"""))
    def top_trades_over_time(t, gender=_gender):
        return rounded(ET.top_trades_over_time(iti(t), gender), 6, "Share")

    @query(f"top_5_trades_{_gender.lower()}_2023", sql(f"""
    SELECT trade AS "Trade", n AS "Num. students", round_even(n::DOUBLE/SUM(n) OVER (),2) AS "Share" FROM (SELECT reported_branch_or_trade AS trade, COUNT(DISTINCT aadhar_no) AS n
    FROM {ITI} AND academic_year=2023 AND gender='{_gender}' GROUP BY 1) ORDER BY "Share" DESC, n DESC, trade LIMIT 5"""))
    def top_trades_2023(t, gender=_gender):
        return ET.top_trades(ET.in_year(iti(t)), gender)


@query("top_5_trades_wide", _with(TRADES, """
SELECT "Year", COUNT(*) AS trades, SUM(n)::BIGINT AS students FROM (SELECT academic_year AS "Year", n FROM ts WHERE gender='Male' QUALIFY ROW_NUMBER() OVER (PARTITION BY academic_year ORDER BY n DESC, trade)<=5) GROUP BY 1"""))
def top_5_trades_wide(t):
    wide = ET.top_trades_over_time_wide(iti(t), "Male")
    cells = [F.col(f"`{c}`") for c in wide.columns if c.endswith(ET.STUDENTS)]
    present = sum((c.isNotNull().cast("long") for c in cells), F.lit(0).cast("long"))
    return wide.select("Year", present.alias("trades"), sum((F.coalesce(c, F.lit(0)) for c in cells), F.lit(0)).alias("students"))


RANKED = """SELECT {cols}, n AS "Num. students", round_even(100*n::DOUBLE/SUM(n) OVER (),1) AS "Share (%)" FROM (SELECT {keys}, COUNT(DISTINCT aadhar_no) AS n FROM {rows} GROUP BY ALL) {tail}"""


@query("top_10_trades_by_enrollment_2023", sql(RANKED.format(cols='reported_branch_or_trade AS "Trade"', keys="reported_branch_or_trade", rows=ITI + " AND academic_year=2023", tail="ORDER BY n DESC, reported_branch_or_trade LIMIT 10")))
def top_10_trades(t):
    return ET.top_by_enrollment(ET.in_year(iti(t)))


@query("top_10_branches_by_enrollment_2023", sql(RANKED.format(cols='reported_branch_or_trade AS "Branch"', keys="reported_branch_or_trade", rows=DIPLOMA + " AND academic_year=2023", tail="ORDER BY n DESC, reported_branch_or_trade LIMIT 10")))
def top_10_branches(t):
    return ET.top_by_enrollment(ET.in_year(diploma(t)), "Branch")


@query("top_10_iti_institutes_by_enrollment_2023", sql(RANKED.format(cols='reported_institute AS "Institute", type_of_institute AS "Type"', keys="reported_institute, type_of_institute", rows=ITI + " AND academic_year=2023", tail="ORDER BY n DESC, reported_institute LIMIT 10")))
def top_10_institutes(t):
    return ET.top_institutes(ET.in_year(iti(t)))


@query("iti_home_districts_2023", sql(RANKED.format(cols="district", keys="district", rows=ITI + " AND academic_year=2023", tail="")))
def iti_home_districts(t):
    return ET.home_places(ET.in_year(iti(t)))


@query("diploma_home_states_2023", sql(RANKED.format(cols="state", keys="state", rows=DIPLOMA + " AND academic_year=2023", tail="")))
def diploma_home_states(t):
    return ET.home_places(ET.in_year(diploma(t)), "state")


@query("iti_top_5_boards_2023", sql(RANKED.format(cols='highest_qualification_exam_board AS "Board"', keys="highest_qualification_exam_board", rows="marks WHERE module='ITI' AND academic_year=2023", tail="ORDER BY n DESC, highest_qualification_exam_board LIMIT 5")))
def iti_top_boards(t):
    return ET.top_boards(ET.in_year(S.mark_rows(t, "ITI")))


@query("trades_over_time", sql("""SELECT academic_year AS "Year", COUNT(DISTINCT trade) AS "Num. trades" FROM strength WHERE module='ITI' GROUP BY 1"""))
def trades_over_time(t):
    return ET.courses_over_time(S.strength(t, "ITI"), "trade", "Num. trades")


@query("branches_over_time", sql("""SELECT academic_year AS "Year", COUNT(DISTINCT branch) AS "Num. branches" FROM strength WHERE module='Diploma' GROUP BY 1"""))
def branches_over_time(t):
    return ET.courses_over_time(S.strength(t, "Diploma"), "branch", "Num. branches")


@query("top_10_itis_by_num_trades_2023", sql(f"""
SELECT reported_institute AS "Institute", type_of_institute AS "Type", COUNT(DISTINCT trade) AS "Num. trades" FROM strength s JOIN (SELECT DISTINCT sams_code, reported_institute, type_of_institute FROM {ITI} AND academic_year=2023) USING (sams_code)
WHERE s.module='ITI' AND s.academic_year=2023 GROUP BY sams_code, 1, 2 ORDER BY 3 DESC, 1 LIMIT 10"""))
def top_10_itis_by_trades(t):
    return ET.top_institutes_by_courses(ET.in_year(S.strength(t, "ITI")), ET.in_year(iti(t)), "trade", "Num. trades")


@query("student_locations_2023", _with(PLACES + ",\n" + ALONG, """
SELECT ROUND(student_long,6) AS student_long, ROUND(student_lat,6) AS student_lat, COUNT(DISTINCT aadhar_no) AS "Num. students" FROM located WHERE academic_year=2023 AND student_lat IS NOT NULL GROUP BY 1,2"""))
def student_locations(t):
    return rounded(ET.student_locations(ET.in_year(located(t))), 6, "student_long", "student_lat")


def boxes(t):
    """A square per nation as an edge table, in the plane of the stand-in coordinates."""
    x0, x1 = 82 + F.col("n_nationkey") / 5 - 0.05, 82 + F.col("n_nationkey") / 5 + 0.05
    y0, y1 = F.lit(17.0), 19.0 + F.col("n_regionkey") / 2
    edge = lambda a, b, c, d: F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))
    sides = F.array(edge(x0, y0, x1, y0), edge(x1, y0, x1, y1), edge(x1, y1, x0, y1), edge(x0, y1, x0, y0))
    return t.nation.select(F.col("n_name").alias("poly_id"), F.lit(0).alias("ring"), F.inline(sides))


@query("itis_inside_blocks_2023", _with(PLACES + ",\n" + ALONG, """
SELECT type_of_institute, reported_institute, n AS "Num. students", ROUND(x,6) AS institute_long, ROUND(y,6) AS institute_lat FROM
 (SELECT type_of_institute, reported_institute, COUNT(DISTINCT aadhar_no) AS n, MIN(institute_long) AS x, MIN(institute_lat) AS y FROM located WHERE academic_year=2023 GROUP BY 1,2)
WHERE EXISTS (SELECT 1 FROM nation WHERE x >= 82+n_nationkey/5.0::DOUBLE-0.05 AND x < 82+n_nationkey/5.0::DOUBLE+0.05 AND y >= 17 AND y < 19+n_regionkey/2.0)"""))
def itis_inside(t):
    return rounded(ET.institute_points(ET.in_year(located(t)), boxes(t)), 6, "institute_long", "institute_lat")


@query("point_in_polygon", """
SELECT c_custkey, n_name AS poly_id FROM (SELECT c_custkey, c_nationkey*4+c_acctbal/2000 AS x, c_acctbal/1000 AS y FROM customer)
JOIN nation ON x >= n_nationkey*4 AND x < n_nationkey*4+3 AND y >= -1 AND y < 4+n_regionkey""")
def point_in_polygon(t):
    from rollbook.operators.spatial import points_in_polygons

    x0, y0 = (F.col("n_nationkey") * 4).cast("double"), F.lit(-1.0)
    x1, y1 = x0 + 3, (F.col("n_regionkey") + 4).cast("double")
    edge = lambda a, b, c, d: F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))
    sides = F.array(edge(x0, y0, x1, y0), edge(x1, y0, x1, y1), edge(x1, y1, x0, y1), edge(x0, y1, x0, y0))
    edges = t.nation.select(F.col("n_name").alias("poly_id"), F.inline(sides))
    points = t.customer.select("c_custkey", (F.col("c_nationkey") * 4 + F.col("c_acctbal") / 2000).alias("x"), (F.col("c_acctbal") / 1000).alias("y"))
    return points.join(points_in_polygons(points, edges, "x", "y"), ["x", "y"]).select("c_custkey", "poly_id")


# --- approximate names ---------------------------------------------------------------

@query("enrollment_by_block_2023", sql(f"""
SELECT c.district, c.shape_key, e.block AS block_match, e.block AS block, n AS aadhar_no FROM (SELECT DISTINCT n_name AS district, n_name || '/' || c_mktsegment AS shape_key, 'Block ' || c_mktsegment AS b FROM customer JOIN nation ON c_nationkey=n_nationkey) c
LEFT JOIN (SELECT district, block, COUNT(DISTINCT aadhar_no) AS n FROM {ITI} AND academic_year=2023 GROUP BY 1,2) e ON c.district=e.district AND c.b=e.block"""))
def enrollment_by_block(t):
    """Block names of the shapes miss their first letter; the segments stay far apart."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    shapes = named.select(F.col("n_name").alias("district"), F.concat_ws("/", "n_name", "c_mktsegment").alias("shape_key"),
                          F.concat(F.lit("lock "), "c_mktsegment").alias("block")).distinct()
    return ET.enrollment_by_shape(shapes, ET.in_year(iti(t)), "block", ["district"])


@query("enrollment_by_state_2023", sql(f"""
SELECT r_regionkey, r_name AS state_match, r_name AS state, n AS aadhar_no FROM region LEFT JOIN (SELECT state, COUNT(DISTINCT aadhar_no) AS n FROM {ITI} AND academic_year=2023 GROUP BY 1) ON r_name=state"""))
def enrollment_by_state(t):
    shapes = t.region.select("r_regionkey", F.concat("r_name", F.lit("S")).alias("state"))
    return ET.enrollment_by_shape(shapes, ET.in_year(iti(t)), "state")


@query("fuzzy_join", r"""
WITH l AS (SELECT p_partkey, p_type, substr(p_name,1,1) || substr(p_name,3) AS short FROM part), r AS (SELECT p_type, p_name, COUNT(*) AS parts FROM part GROUP BY 1,2),
d AS (SELECT DISTINCT p_type, short, '%' || regexp_replace(short, '(.)', '\1%', 'g') AS pattern FROM l),
m AS (SELECT d.p_type, short, arg_min(p_name, (length(p_name), p_name)) AS p_name_match FROM d JOIN r ON d.p_type=r.p_type AND p_name LIKE pattern GROUP BY 1,2)
SELECT p_partkey, l.p_type, p_name_match, r.p_name, parts FROM l JOIN m ON l.p_type=m.p_type AND l.short=m.short JOIN r ON r.p_type=l.p_type AND r.p_name=p_name_match""")
def fuzzy_join_parts(t):
    """Part names without their second letter, joined back by type.

    The best match always holds the shortened name in order and is the shortest such name.
    """
    from rollbook.operators.fuzzy import fuzzy_join

    short = F.concat(F.substring("p_name", 1, 1), F.substr("p_name", F.lit(3)))
    left = t.part.select("p_partkey", "p_type", short.alias("p_name"))
    right = A.count_by(t.part, ["p_type", "p_name"], "parts")
    return fuzzy_join(left, right, "p_name", ["p_type"], "left", 70)


@query("fuzzy_best_match", r"""
WITH l AS (SELECT p_partkey, substr(p_name,1,1) || substr(p_name,3) AS p_name FROM part), r AS (SELECT DISTINCT p_name AS choice FROM part),
d AS (SELECT DISTINCT p_name, '%' || regexp_replace(p_name, '(.)', '\1%', 'g') AS pattern FROM l),
m AS (SELECT p_name, arg_min(choice, (length(choice), choice)) AS found FROM d JOIN r ON choice LIKE pattern GROUP BY 1)
SELECT p_partkey, p_name, found FROM l LEFT JOIN m USING (p_name)""")
def fuzzy_best_match(t):
    """Best part name for names without their second letter: the shortest that holds the letters in order."""
    from rollbook.operators.fuzzy import best_fuzzy_match

    short = F.concat(F.substring("p_name", 1, 1), F.substr("p_name", F.lit(3)))
    names = t.part.select(short.alias("p_name"), "p_partkey")
    return best_fuzzy_match(names, "p_name", t.part.select("p_name").distinct(), 80.0, "found").select("p_partkey", "p_name", "found")


@query("osa_match", """
WITH l AS (SELECT p_partkey, substr(p_name,2,1) || substr(p_name,1,1) || substr(p_name,3) AS p_name FROM part), r AS (SELECT DISTINCT p_name AS choice FROM part),
d AS (SELECT DISTINCT p_name FROM l), m AS (SELECT p_name, arg_min(choice, (damerau_levenshtein(p_name, choice), choice)) AS found FROM d, r WHERE damerau_levenshtein(p_name, choice) <= 3 GROUP BY 1)
SELECT p_partkey, l.p_name, found FROM l LEFT JOIN m USING (p_name)""")
def osa_match(t):
    from rollbook.operators.fuzzy import best_osa_match

    swapped = F.concat(F.substring("p_name", 2, 1), F.substring("p_name", 1, 1), F.substr("p_name", F.lit(3)))
    names = t.part.select(swapped.alias("p_name"), "p_partkey")
    return best_osa_match(names, "p_name", t.part.select("p_name").distinct(), 3, "found")


# --- marks, places, income -------------------------------------------------------------

@query("marks_histogram", sql("""
WITH h AS (SELECT module, CAST(floor(percentage+0.5) AS DOUBLE) AS bin, COUNT(*) AS n FROM marks WHERE module IN ('ITI','Diploma') AND percentage IS NOT NULL GROUP BY 1,2)
SELECT * FROM h UNION ALL SELECT 'All', bin, CAST(SUM(n) AS BIGINT) FROM h GROUP BY bin""").replace("\nWITH h AS", ",\nh AS"))
def marks_histogram(t):
    return ET.marks_histogram({m: S.mark_rows(t, m) for m in ["ITI", "Diploma"]})


@query("iti_marks_by_gender_2023", sql("""
SELECT gender, ROUND(AVG(m.percentage),4) AS mean, ROUND(STDDEV_SAMP(m.percentage),4) AS std FROM marks m JOIN enrolled e USING (aadhar_no, academic_year) WHERE m.module='ITI' AND e.module='ITI' AND academic_year=2023 GROUP BY 1"""))
def iti_marks_by_gender(t):
    return rounded(ET.marks_by_gender(ET.in_year(S.mark_rows(t, "ITI")), ET.in_year(iti(t))), 4, "mean", "std")


for _year in (2018, 2023):
    @query(f"iti_locality_by_gender_{_year}", sql(f"""
    SELECT gender, NULLIF(COUNT(DISTINCT aadhar_no) FILTER (NOT local),0) AS "false", NULLIF(COUNT(DISTINCT aadhar_no) FILTER (local),0) AS "true" FROM {ITI} AND academic_year={_year} GROUP BY 1"""))
    def iti_locality(t, year=_year):
        return ET.locality_by_gender(iti(t), year)


@query("iti_locality_and_distance_2023", _with(PLACES + ",\n" + ALONG, """
SELECT local, round_even(AVG(distance) FILTER (gender='Female'),1) AS "Female", round_even(AVG(distance) FILTER (gender='Male'),1) AS "Male" FROM located WHERE academic_year=2023 GROUP BY 1"""))
def iti_locality_and_distance(t):
    return ET.locality_and_distance(ET.in_year(located(t)))


INCOMES = ["0-2,50,000", "2,50,000-8,00,000", "Above 8,00,000", "OTHER"]


@query("diploma_annual_income_over_time", sql("SELECT academic_year AS \"Year\", " + ", ".join(f"""COUNT(DISTINCT aadhar_no) FILTER (annual_income='{i}') AS "{i}" """ for i in INCOMES) + f" FROM {DIPLOMA} GROUP BY 1"))
def diploma_income(t):
    return ET.category_over_time(diploma(t), "annual_income", INCOMES)


@query("diploma_share_below_income", sql(f"SELECT academic_year, round_even(COUNT(DISTINCT aadhar_no) FILTER (annual_income='0-2,50,000')::DOUBLE/COUNT(DISTINCT aadhar_no)*100,1) AS share_below FROM {DIPLOMA} GROUP BY 1"))
def diploma_share_below(t):
    return ET.share_below_income(diploma(t), ["0-2,50,000"])


GROUPS = ["General", "OBC/SEBC", "SC", "ST"]


@query("diploma_social_category_over_time", sql("SELECT academic_year AS \"Year\", " + ", ".join(f"""COUNT(DISTINCT aadhar_no) FILTER (social_category='{g}') AS "{g}" """ for g in GROUPS) + f""", COUNT(DISTINCT aadhar_no) FILTER (social_category='Other') AS "Unreserved" FROM {DIPLOMA} GROUP BY 1"""))
def diploma_social(t):
    return ET.category_over_time(diploma(t), "social_category", [*GROUPS, "Other"], {"Other": "Unreserved"})


@query("diploma_income_by_category_2023", sql("SELECT social_category AS \"Social Category\", " + ", ".join(f"""COUNT(DISTINCT aadhar_no) FILTER (annual_income='{i}') AS "{i}" """ for i in INCOMES) + f" FROM {DIPLOMA} AND academic_year=2023 GROUP BY 1"))
def diploma_income_by_category(t):
    return ET.income_by_category(ET.in_year(diploma(t)), INCOMES)


LEVELS = ["10th", "12th", "Diploma", "Graduate and above", "ITI", "Unknown"]
_LEVELS = f"(SELECT gender, COALESCE(highest_qualification,'Unknown') AS q, aadhar_no FROM {ITI} AND academic_year=2023)"


@query("iti_highest_qualification_by_gender_2023", sql("SELECT gender, " + ", ".join(f"""COUNT(DISTINCT aadhar_no) FILTER (q='{q}') AS "{q}" """ for q in LEVELS) + f" FROM {_LEVELS} GROUP BY 1"))
def qualification_levels(t):
    return ET.qualification_by_gender(ET.in_year(iti(t)), LEVELS)[0]


@query("iti_highest_qualification_by_gender_2023_pct", sql(f"""
SELECT gender, {", ".join(f'round_even("{q}"::DOUBLE/total*100,1) AS "{q} (%)"' for q in LEVELS)}, total AS "Num. students" FROM (SELECT *, {"+".join(f'"{q}"' for q in LEVELS)} AS total FROM
 (SELECT gender, {", ".join(f"COUNT(DISTINCT aadhar_no) FILTER (q='{q}') AS " + chr(34) + q + chr(34) for q in LEVELS)} FROM {_LEVELS} GROUP BY 1))"""))
def qualification_shares(t):
    return ET.qualification_by_gender(ET.in_year(iti(t)), LEVELS)[1]


EXAMS = ["+2 Science", "10th Pass", "ITI"]


@query("iti_pass_by_gender_2023", sql("SELECT gender, " + ", ".join(f"""COUNT(DISTINCT e.aadhar_no) FILTER (exam_name='{x}') AS "{x}" """ for x in EXAMS) +
       " FROM enrolled e LEFT JOIN marks m ON m.module='ITI' AND e.aadhar_no=m.aadhar_no AND e.academic_year=m.academic_year WHERE e.module='ITI' AND e.academic_year=2023 GROUP BY 1"))
def pass_by_gender(t):
    return ET.examination_by_gender(ET.in_year(iti(t)), ET.in_year(S.mark_rows(t, "ITI")), EXAMS)[0]


# --- cutoffs and vacancies ----------------------------------------------------------------

@query("iti_institute_cutoffs_2023", sql("""
SELECT trade AS "Trade", gender AS "Gender", round_even(AVG(cutoff) FILTER (social_category='UR'),1) AS "UR", round_even(AVG(cutoff) FILTER (social_category='SC'),1) AS "SC", CAST(NULL AS DOUBLE) AS "ST"
FROM cutoffs WHERE module='ITI' AND academic_year=2023 AND contains(institute_name,'ITI Supplier#00000000') AND qual='10th Pass' AND trade IN ('Brand#1','Brand#12') AND NOT contains(applicant_type,'OMC') GROUP BY 1,2"""))
def iti_institute_cutoffs(t):
    return ET.institute_cutoffs(ET.in_year(S.cutoff_rows(t)), "ITI Supplier#00000000", "10th Pass", ["UR", "SC", "ST"], ["Brand#1", "Brand#12"], "OMC")


for _kind in ("Govt.", "Pvt."):
    @query(f"hist_{_kind[:-1].lower()}_iti_vacancy_ratios_2023", sql(f"""
    SELECT CAST(floor(ratio+0.5) AS DOUBLE) AS bin, COUNT(*) AS n FROM (SELECT SUM(vacancies)::DOUBLE/SUM(strength)*100 AS ratio FROM vac WHERE type_of_institute='{_kind}' AND academic_year=2023 GROUP BY sams_code) GROUP BY 1"""))
    def vacancy_histogram(t, kind=_kind):
        return ET.vacancy_histogram(ET.in_year(S.vacancy_rows(t)), kind)


@query("trades_by_gender_2023", sql(f"""
SELECT reported_branch_or_trade, printf('%.1f', f::DOUBLE/(f+m)*100) AS "Female", printf('%.1f', m::DOUBLE/(f+m)*100) AS "Male", f+m AS "Total" FROM
 (SELECT reported_branch_or_trade, COUNT(aadhar_no) FILTER (gender='Female') AS f, COUNT(aadhar_no) FILTER (gender='Male') AS m FROM {ITI} AND academic_year=2023 GROUP BY 1)"""))
def trades_by_gender(t):
    counts = ET.cross_counts(ET.in_year(iti(t)), "reported_branch_or_trade", "gender", ET.GENDERS)
    return ET.cross_percentages(counts, "reported_branch_or_trade")


@query("trades_by_qualification_2023", sql(f"""
SELECT reported_branch_or_trade, {", ".join(f"COUNT(aadhar_no) FILTER (highest_qualification='{q}') AS " + chr(34) + q + chr(34) for q in LEVELS[:-1])}, COUNT(aadhar_no) FILTER (highest_qualification IS NOT NULL) AS "Total"
FROM {ITI} AND academic_year=2023 AND highest_qualification IS NOT NULL GROUP BY 1"""))
def trades_by_qualification(t):
    return ET.cross_counts(ET.in_year(iti(t)), "reported_branch_or_trade", "highest_qualification", LEVELS[:-1])


@query("marks_by_trade", _with(MATCHED, f"""
SELECT trade AS "Trade", {STATS} FROM (SELECT trade, percentage AS v FROM above WHERE percentage>cutoff) GROUP BY 1"""))
def marks_by_trade(t):
    return A.summary_stats(matched(t), "percentage", "trade", "Trade")


@query("marks_by_demographics", _with(MATCHED, """
SELECT gender, round_even(AVG(percentage) FILTER (social_category='UR'),1) AS "UR", round_even(AVG(percentage) FILTER (social_category='SC'),1) AS "SC" FROM above WHERE percentage>cutoff GROUP BY 1"""))
def marks_by_demographics(t):
    from rollbook.operators.reshape import pivot_mean

    return pivot_mean(matched(t), ["gender"], "social_category", "percentage", ["UR", "SC"])


@query("cutoff_by_trade_and_category", sql("""
SELECT trade AS "Trade", round_even(AVG(cutoff) FILTER (social_category='SC'),1) AS "SC", round_even(AVG(cutoff) FILTER (social_category='UR'),1) AS "UR", CAST(NULL AS DOUBLE) AS "Other"
FROM cutoffs WHERE module='ITI' AND academic_year=2023 GROUP BY 1"""))
def cutoff_by_trade(t):
    coarse = ET.cutoffs_with_type(ET.in_year(S.cutoff_rows(t)), ET.in_year(iti(t)))
    return ET.mean_cutoffs(coarse, "social_category", ["SC", "UR", "Other"])


@query("distance_by_type_2023", _with(PLACES + ",\n" + ALONG, f"""
SELECT 'All' AS "Type", {STATS} FROM (SELECT distance AS v FROM located WHERE academic_year=2023) UNION ALL SELECT type_of_institute, {STATS} FROM (SELECT type_of_institute, distance AS v FROM located WHERE academic_year=2023) GROUP BY 1"""))
def distance_by_type(t):
    return A.summary_stats_with_all(ET.in_year(located(t)), "distance", "type_of_institute", "Type")


@query("vacancy_by_trade_2023", sql(f"""SELECT trade AS "Trade", {STATS} FROM (SELECT trade, vacancies AS v FROM vac WHERE academic_year=2023) GROUP BY 1"""))
def vacancy_by_trade(t):
    return A.summary_stats(ET.in_year(S.vacancy_rows(t)), "vacancies", "trade", "Trade")


INST_VAC = f"""iv AS (SELECT v.*, n.reported_institute, n.institute_district, n.type_of_institute, round_even(vacancies::DOUBLE/strength,2) AS vacancy_ratio FROM
 (SELECT sams_code, CAST(SUM(enrollment) AS BIGINT) AS enrollment, CAST(SUM(strength) AS BIGINT) AS strength, CAST(SUM(vacancies) AS BIGINT) AS vacancies FROM vac WHERE academic_year=2023 GROUP BY 1) v
 LEFT JOIN (SELECT DISTINCT sams_code, reported_institute, institute_district, type_of_institute FROM {ITI} AND academic_year=2023) n USING (sams_code))"""


@query("vacancies_by_institute_2023", _with(INST_VAC, "SELECT * FROM iv"))
def vacancies_by_institute(t):
    return ET.vacancies_by_institute(ET.in_year(S.vacancy_rows(t)), ET.in_year(iti(t)))


@query("vacancies_by_district_2023", _with(INST_VAC, """
SELECT institute_district, CAST(SUM(enrollment) AS BIGINT) AS enrollment, CAST(SUM(strength) AS BIGINT) AS strength, CAST(SUM(vacancies) AS BIGINT) AS vacancies, round_even(SUM(vacancies)::DOUBLE/SUM(strength),2) AS vacancy_ratio FROM iv GROUP BY 1"""))
def vacancies_by_district(t):
    rows = ET.vacancies_by_institute(ET.in_year(S.vacancy_rows(t)), ET.in_year(iti(t)))
    return ET.vacancy_totals(rows, ["institute_district"])


@query("top_bottom_vacant_institutes_2023", _with(INST_VAC, """
SELECT 'top' AS kind, * FROM (SELECT sams_code, vacancies FROM iv ORDER BY vacancies DESC, sams_code LIMIT 10) UNION ALL SELECT 'bottom', * FROM (SELECT sams_code, vacancies FROM iv ORDER BY vacancies, sams_code LIMIT 10)"""))
def top_bottom_vacant(t):
    rows = ET.vacancies_by_institute(ET.in_year(S.vacancy_rows(t)), ET.in_year(iti(t))).select("sams_code", "vacancies")
    high, low = ET.most_and_least(rows, "vacancies", ["sams_code"])
    return high.select(F.lit("top").alias("kind"), "*").unionByName(low.select(F.lit("bottom").alias("kind"), "*"))


@query("female_share_by_district_2023", sql(f"""
SELECT district, NULLIF(COUNT(aadhar_no) FILTER (gender='Female'),0) AS "Female", NULLIF(COUNT(aadhar_no) FILTER (gender='Male'),0) AS "Male",
 round_even(NULLIF(COUNT(aadhar_no) FILTER (gender='Female'),0)::DOUBLE/(NULLIF(COUNT(aadhar_no) FILTER (gender='Female'),0)+NULLIF(COUNT(aadhar_no) FILTER (gender='Male'),0)),2) AS "Female share" FROM {ITI} AND academic_year=2023 GROUP BY 1"""))
def female_share_by_district(t):
    return ET.female_share(ET.in_year(iti(t)), "district")


# --- trainees ----------------------------------------------------------------------------

def _trainee_sql(where: str, measure: str) -> str:
    return _with(TRAINEES, f"""SELECT year, g+p AS "Total", g AS "Govt.", p AS "Pvt." FROM (SELECT year, {measure} FILTER (type_of_institute='Govt.') AS g, {measure} FILTER (type_of_institute='Pvt.') AS p FROM tr {where} GROUP BY 1)""")


_DISTINCT = "COUNT(DISTINCT roll_num)"
for _measure in ("admitted", "passed", "dropout", "retained"):
    for _gender in (None, "Female", "Male"):
        _conditions = ([f"gender='{_gender}'"] if _gender else []) + (["passed"] if _measure == "passed" else [])
        _where = ("WHERE " + " AND ".join(_conditions)) if _conditions else ""
        if _measure in ("admitted", "passed"):
            _text = _trainee_sql(_where, _DISTINCT)
        else:
            _sum = "SUM(CAST(dropout AS INTEGER))" if _measure == "dropout" else "SUM(1-CAST(dropout AS INTEGER))"
            _text = _with(TRAINEES, f"""SELECT year, CAST(g+p AS BIGINT) AS "Total", CAST(g AS BIGINT) AS "Govt.", CAST(p AS BIGINT) AS "Pvt." FROM (SELECT year,
             COALESCE({_sum} FILTER (type_of_institute='Govt.'),0) AS g, COALESCE({_sum} FILTER (type_of_institute='Pvt.'),0) AS p FROM tr {_where} GROUP BY 1)""")

        @query(f"trainees_{_measure}" + (f"_{_gender.lower()}" if _gender else ""), _text)
        def trainee_table(t, measure=_measure, gender=_gender):
            return TR.trainee_table(trainees(t), measure, gender, ET.KINDS)


@query("students_admitted_female", sql(f"""
SELECT academic_year AS year, g+p AS "Total", g AS "Govt.", p AS "Pvt." FROM (SELECT academic_year, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Govt.') AS g, COUNT(DISTINCT aadhar_no) FILTER (type_of_institute='Pvt.') AS p
FROM {ITI} AND gender='Female' AND academic_year>2017 GROUP BY 1)"""))
def students_admitted_female(t):
    return TR.admitted_students(iti(t), "Female", ET.KINDS)


# --- demand ------------------------------------------------------------------------------

OPTIONS = """opt AS (SELECT p.barcode, p.aadhar_no, p.academic_year, l.l_linenumber AS option_no, l.inst AS institute_name, l.p_brand AS trade, l.kind AS type_of_institute, p.district,
 f.inst AS reported_institute, f.p_brand AS reported_branch_or_trade, f.inst_id AS sams_code FROM people p JOIN line1 f ON p.o_orderkey=f.l_orderkey JOIN lines l ON p.o_orderkey=l.l_orderkey WHERE module='ITI'),
firsts AS (SELECT * FROM opt WHERE option_no=1 QUALIFY ROW_NUMBER() OVER (PARTITION BY aadhar_no, academic_year ORDER BY barcode, trade, institute_name)=1),
seats AS (SELECT s.*, i.institute_name, i.type_of_institute FROM strength s JOIN (SELECT DISTINCT sams_code, institute_name, type_of_institute FROM inst) i USING (sams_code) WHERE category='Total' AND module='ITI')"""
YEARS = list(range(2017, 2024))
_year_cells = lambda measure: ", ".join(f'{measure} FILTER (academic_year={y}) AS "{y}"' for y in YEARS)


@described_once
def options(t):
    kinds = t.supplier.select(F.concat(F.lit("ITI "), "s_name").alias("institute_name"), F.when(F.col("s_acctbal") >= 5000, "Govt.").otherwise("Pvt.").alias("type_of_institute"))
    return S.itemised(t).join(kinds, "institute_name", "left")


@described_once
def first_options(t):
    return DM.first_choices(options(t), ["trade", "institute_name"])


@described_once
def seats(t):
    # Names and types hang on the institute alone, so those of its ITI trades are all that can meet its ITI seats.
    names = S.institutes(t, "ITI").select("sams_code", "institute_name", "type_of_institute").distinct()
    return S.strength(t, "ITI").join(names, "sams_code")


@query("trade_ranking", _with(OPTIONS, f"""SELECT trade, COUNT(DISTINCT (academic_year, aadhar_no)) AS "Applicants", {_year_cells('COUNT(DISTINCT aadhar_no)')} FROM firsts GROUP BY 1"""))
def trade_ranking(t):
    return DM.applicants_by_year(first_options(t), "trade", years=YEARS)


@query("institute_ranking", _with(OPTIONS, f"""SELECT institute_name, COUNT(DISTINCT (academic_year, aadhar_no)) AS "Applicants", {_year_cells('COUNT(DISTINCT aadhar_no)')} FROM firsts GROUP BY 1"""))
def institute_ranking(t):
    return DM.applicants_by_year(first_options(t), "institute_name", years=YEARS)


@query("seats_by_trade", _with(OPTIONS, f"""SELECT trade, SUM(strength) AS "Total Seats", {", ".join(f'COALESCE(SUM(strength) FILTER (academic_year={y}),0) AS "{y}"' for y in YEARS)} FROM seats GROUP BY 1"""))
def seats_by_trade(t):
    return DM.seats_by_year(seats(t), "trade", YEARS)


TRADE_DEMAND = """td AS (SELECT upper(substr(trade,1,1)) || lower(substr(trade,2)) AS trade, seats, applicants, seats-applicants AS available_seats, CASE WHEN applicants>seats*1.1 THEN 'Overutilized' WHEN applicants<seats*0.9 THEN 'Underutilized' ELSE 'Balanced' END AS utilisation
 FROM (SELECT trade, SUM(strength) AS seats FROM seats GROUP BY 1) JOIN (SELECT trade, COUNT(DISTINCT (academic_year, aadhar_no)) AS applicants FROM firsts GROUP BY 1) USING (trade))"""


@described_once
def trade_demand(t):
    s, a = DM.seats_by_year(seats(t), "trade", YEARS), DM.applicants_by_year(first_options(t), "trade", years=YEARS)
    return DM.seats_against_applicants(DM.same_names(s, "trade"), DM.same_names(a, "trade"), "trade")


@query("seats_against_demand_by_trade", _with(OPTIONS + ",\n" + TRADE_DEMAND, "SELECT * FROM td"))
def seats_against_demand_by_trade(t):
    return trade_demand(t)


@query("utilisation_lists", _with(OPTIONS + ",\n" + TRADE_DEMAND, """SELECT utilisation, string_agg(e, ', ' ORDER BY e) AS details FROM (SELECT utilisation, trade || ': ' || CAST(available_seats AS BIGINT) AS e FROM td) GROUP BY 1"""))
def utilisation_lists(t):
    return DM.utilisation_lists(trade_demand(t).withColumn("available_seats", F.col("available_seats").cast("long")), "trade")


@query("most_room_by_trade", _with(OPTIONS + ",\n" + TRADE_DEMAND, "SELECT * FROM td WHERE available_seats>0 ORDER BY available_seats DESC, trade LIMIT 10"))
def most_room(t):
    return DM.with_most_room(trade_demand(t), "trade")


@query("overloaded_institutes", _with(OPTIONS, """
SELECT institute_name, seats, applicants, seats-applicants AS available_seats FROM (SELECT institute_name, SUM(strength) AS seats FROM seats GROUP BY 1)
JOIN (SELECT institute_name, COUNT(DISTINCT (academic_year, aadhar_no))*15 AS applicants FROM firsts GROUP BY 1) USING (institute_name) WHERE seats<applicants ORDER BY 4, 1 LIMIT 10"""))
def overloaded_institutes(t):
    s = DM.seats_by_year(seats(t), "institute_name", YEARS)
    a = DM.applicants_by_year(first_options(t), "institute_name", years=YEARS).withColumn("Applicants", F.col("Applicants") * 15)
    return DM.overloaded(DM.seats_against_applicants(s, a, "institute_name").drop("utilisation"), "institute_name")


@query("seats_left_by_institute_year", _with(OPTIONS, """
SELECT institute_name, s AS "Total Seats", a AS "Applicants", GREATEST(s-a,0) AS "Available Seats", GREATEST(s23-a23,0) AS "2023_available", s23 AS "2023_seats", a23 AS "2023_applicants" FROM
 (SELECT institute_name, SUM(strength) AS s, COALESCE(SUM(strength) FILTER (academic_year=2023),0) AS s23 FROM seats GROUP BY 1) JOIN
 (SELECT institute_name, COUNT(DISTINCT (academic_year, aadhar_no)) AS a, COUNT(DISTINCT aadhar_no) FILTER (academic_year=2023) AS a23 FROM firsts GROUP BY 1) USING (institute_name)"""))
def seats_left_by_institute_year(t):
    s, a = DM.seats_by_year(seats(t), "institute_name", YEARS), DM.applicants_by_year(first_options(t), "institute_name", years=YEARS)
    return DM.seats_against_applicants_by_year(s, a, "institute_name", [2023])


@query("seats_by_type_year", _with(OPTIONS, """
SELECT academic_year, COALESCE(SUM(v) FILTER (type_of_institute='Govt.'),0) AS "Govt Available Seats", COALESCE(SUM(v) FILTER (type_of_institute='Pvt.'),0) AS "Private Available Seats" FROM
 (SELECT academic_year, type_of_institute, COALESCE(s,0)-COALESCE(a,0) AS v FROM (SELECT academic_year, type_of_institute, SUM(strength) AS s FROM seats GROUP BY 1,2) FULL OUTER JOIN
  (SELECT academic_year, type_of_institute, COUNT(DISTINCT aadhar_no) AS a FROM firsts GROUP BY 1,2) USING (academic_year, type_of_institute)) GROUP BY 1"""))
def seats_by_type_year(t):
    return DM.available_by_year_and_type(DM.seats_against_demand(seats(t), first_options(t), ["academic_year", "type_of_institute"]))


@query("seat_growth", _with(OPTIONS, """
SELECT type_of_institute, academic_year, strength, ROUND((strength/LAG(strength) OVER (PARTITION BY type_of_institute ORDER BY academic_year)-1)*100,6) AS growth_pct FROM
 (SELECT type_of_institute, academic_year, SUM(strength) AS strength FROM seats GROUP BY 1,2)"""))
def seat_growth(t):
    return rounded(DM.seat_growth(seats(t)), 6, "growth_pct")


@query("demand_frame", _with(OPTIONS, "SELECT trade, academic_year, reported_institute, COUNT(aadhar_no) AS application_count, COUNT(DISTINCT sams_code) AS iti_enrollment FROM opt GROUP BY 1,2,3"))
def demand_frame(t):
    return DM.demand_frame(S.itemised(t))


@query("applicants_by_mix", _with(OPTIONS, """
SELECT academic_year, COUNT(*) FILTER (g=n) AS "Govt", COUNT(*) FILTER (g>0 AND g<n) AS "Mix", COUNT(*) FILTER (g=0) AS "Pvt" FROM (SELECT academic_year, aadhar_no, COUNT(*) FILTER (type_of_institute='Govt.') AS g, COUNT(*) AS n FROM opt GROUP BY 1,2) GROUP BY 1"""))
def applicants_by_mix(t):
    return DM.applicants_by_mix(options(t))


@query("applications_by_year", _with(OPTIONS, "SELECT academic_year, CAST(SUM(n) AS BIGINT) AS applications, COUNT(*) AS applicants, ROUND(AVG(n),6) AS average FROM (SELECT academic_year, aadhar_no, COUNT(*) AS n FROM opt GROUP BY 1,2) GROUP BY 1"))
def applications_by_year(t):
    return rounded(DM.applications_by_year(S.itemised(t)), 6, "average")


@query("options_coverage", sql("""
SELECT academic_year, COUNT(*) AS total_students, COUNT(*) FILTER (k>0) AS with_options, COUNT(*) FILTER (k=0) AS without_options FROM (SELECT academic_year, aadhar_no, MAX(k) AS k FROM
 (SELECT academic_year, aadhar_no, o_orderkey, COUNT(l_orderkey) AS k FROM people LEFT JOIN lineitem ON o_orderkey=l_orderkey WHERE module='ITI' GROUP BY 1,2,3) GROUP BY 1,2) GROUP BY 1"""))
def options_coverage(t):
    rows = S.students(t, "ITI")
    size = Y.list_size(Y.json_records(F.col("option_data"), ["Option_No"]))
    return DM.options_coverage(rows, size, ["academic_year"])


@query("option_quality", sql("""
SELECT district, academic_year, COUNT(*) AS rows, COUNT(*) FILTER (l_orderkey IS NULL OR status IS NULL) AS incomplete, COUNT(*) FILTER (status IS NOT NULL) AS complete, CAST(0 AS BIGINT) AS reported_not_applied, CAST(0 AS BIGINT) AS applied_without_type
FROM people LEFT JOIN lines ON o_orderkey=l_orderkey WHERE module='ITI' GROUP BY 1,2"""))
def option_quality(t):
    rows = VO.applications(S.students(t, "ITI"), ["barcode", "district", "academic_year", "reported_institute", "type_of_institute"])
    return DM.option_quality(rows, ["district", "academic_year"], ["option_no", "trade", "status"])


@query("trade_mismatch", _with(OPTIONS, "SELECT barcode FROM opt WHERE option_no>1 GROUP BY 1 HAVING COUNT(*) FILTER (trade=reported_branch_or_trade)=0"))
def trade_mismatch(t):
    return DM.trade_mismatch(S.itemised(t).where("cast(option_no as int) > 1"))


@query("option_sequences", _with(OPTIONS, """
SELECT CASE WHEN d<h THEN 'Gap in sequence' ELSE 'Complete sequence' END AS status, n=h AND d=n AS exact, COUNT(*) AS n FROM (SELECT barcode, COUNT(*) AS n, MAX(option_no) AS h, COUNT(DISTINCT option_no) AS d FROM opt GROUP BY 1) GROUP BY 1,2"""))
def option_sequences(t):
    return DM.sequence_summary(S.itemised(t), ["barcode"])


# --- higher secondary ------------------------------------------------------------------------

HSS = """h AS (SELECT barcode, academic_year, gender, social_category, percentage, secured_marks, l.p_type AS comp_subject, CAST(l.l_quantity AS INTEGER) AS fail_mark,
 CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag='R') THEN 'YES' ELSE 'NO' END AS compartmental_status FROM people LEFT JOIN (SELECT * FROM lines WHERE l_returnflag='R') l ON o_orderkey=l.l_orderkey
 WHERE module='HSS' AND (o_orderstatus IN ('F','O') OR o_orderkey IN (SELECT l_orderkey FROM lineitem))),
s AS (SELECT DISTINCT barcode, academic_year, gender, social_category, percentage, compartmental_status FROM (SELECT * FROM people WHERE module='HSS') p JOIN
 (SELECT o_orderkey AS k, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag='R') THEN 'YES' ELSE 'NO' END AS compartmental_status FROM orders) c ON p.o_orderkey=c.k),
ho AS (SELECT barcode, CAST(academic_year AS VARCHAR) AS "Year", CAST(l_linenumber AS VARCHAR) AS "OptionNo", status AS "AdmissionStatus" FROM people JOIN lines ON o_orderkey=l_orderkey WHERE module='HSS')"""


@described_once
def hss_students(t):
    from rollbook.functions.values import number

    return S.students(t, "HSS").withColumn("percentage", number(F.col("percentage")))


@query("hss_applicants", _with(HSS, 'SELECT "Year", COUNT(DISTINCT barcode) AS applicants, COUNT(*) AS applications FROM ho GROUP BY 1'))
def hss_applicants(t):
    return ST.applicants_and_applications(S.hss_options(t))


@query("hss_first_choice_status", _with(HSS, """
SELECT "Year", COUNT(DISTINCT barcode) AS "Applicants", COUNT(DISTINCT barcode) FILTER ("AdmissionStatus"='ADMITTED') AS "Admitted", COUNT(DISTINCT barcode) FILTER ("AdmissionStatus"='NOT SELECTED') AS "Not Selected",
 COUNT(DISTINCT barcode) FILTER ("AdmissionStatus"='SELECTED BUT NOT ADMITTED') AS "Selected, Not Admitted", COUNT(DISTINCT barcode) FILTER ("AdmissionStatus"='TC TAKEN') AS "TC Taken" FROM ho WHERE "OptionNo"='1' GROUP BY 1"""))
def hss_first_choice_status(t):
    return ST.first_choice_status(S.hss_options(t))


@query("hss_admitted_anywhere", _with(HSS, """SELECT "Year", COUNT(DISTINCT barcode) AS "No. of Students", COUNT(DISTINCT barcode) FILTER ("AdmissionStatus"='ADMITTED') AS "Admitted Students" FROM ho GROUP BY 1"""))
def hss_admitted_anywhere(t):
    return ST.admitted_anywhere(S.hss_options(t))


@query("hss_compartments_by_year", _with(HSS, """
SELECT academic_year, COUNT(DISTINCT barcode) AS "Applicant Count", COUNT(DISTINCT barcode) FILTER (compartmental_status='YES') AS "Compartment Count",
 round_even(COUNT(DISTINCT barcode) FILTER (compartmental_status='YES')::DOUBLE/COUNT(DISTINCT barcode)*100,2) AS "% with Compartments" FROM h GROUP BY 1"""))
def hss_compartments_by_year(t):
    return ST.compartments_by_year(S.hss_mark_rows(t))


@query("hss_subjects_by_year", _with(HSS, f"""SELECT comp_subject, {_year_cells('COUNT(DISTINCT barcode)')}, COUNT(DISTINCT barcode) AS "Total Count" FROM h WHERE comp_subject IS NOT NULL GROUP BY 1"""))
def hss_subjects_by_year(t):
    return ST.subjects_by_year(S.hss_mark_rows(t), YEARS)


@query("hss_subject_shares", _with(HSS, """
SELECT CASE WHEN share<16.5 THEN 'Other' ELSE comp_subject END AS comp_subject, ROUND(SUM(share),4) AS share FROM (SELECT comp_subject, round_even(COUNT(*)::DOUBLE/SUM(COUNT(*)) OVER ()*100,1) AS share FROM
 (SELECT DISTINCT barcode, comp_subject FROM h WHERE compartmental_status='YES') GROUP BY 1) GROUP BY 1"""))
def hss_subject_shares(t):
    return rounded(ST.subject_shares(S.hss_mark_rows(t), 16.5), 4, "share")


@query("hss_brackets", _with(HSS, """
SELECT CASE WHEN percentage<=20 THEN '<20%' WHEN percentage<=30 THEN '20-30%' WHEN percentage<=50 THEN '30–50%' WHEN percentage<=70 THEN '50–70%' ELSE '>70%' END AS "Percentage", COUNT(DISTINCT barcode) AS "Total_Students",
 COUNT(DISTINCT barcode) FILTER (compartmental_status='YES') AS "With_Compartments" FROM h WHERE percentage BETWEEN 0 AND 100 GROUP BY 1"""))
def hss_brackets(t):
    return ST.brackets(S.hss_mark_rows(t))


@query("hss_compartments_by_subject", _with(HSS, """SELECT comp_subject, COUNT(DISTINCT barcode) AS students, ROUND(100*COUNT(DISTINCT barcode)::DOUBLE/SUM(COUNT(DISTINCT barcode)) OVER (),6) AS share FROM h WHERE compartmental_status='YES' GROUP BY 1"""))
def hss_compartments_by_subject(t):
    return rounded(ST.compartments_by(S.hss_mark_rows(t), "comp_subject"), 6, "share")


@query("hss_rule_violations", _with(HSS, "SELECT barcode, comp_subject, CAST(fail_mark AS DOUBLE) AS comp_fail_mark FROM h WHERE compartmental_status='YES' AND NOT (secured_marks>=197 AND fail_mark<30)"))
def hss_rule_violations(t):
    return ST.rule_violations(S.hss_mark_rows(t)).select("barcode", "comp_subject", "comp_fail_mark")


@query("cross_field_checks", _with(HSS, """
SELECT 'no institute' AS kind, barcode FROM people JOIN lines ON o_orderkey=l_orderkey WHERE module='HSS' AND status='ADMITTED' AND kind='Pvt.'
UNION ALL SELECT 'no subjects', barcode FROM s WHERE compartmental_status='NO'"""))
def cross_field_checks(t):
    """Institutes are blanked for private ones, and all are flagged, to have something to find."""
    options = S.hss_options(t).withColumn("ReportedInstitute", F.when(F.col("TypeofInstitute") != "Pvt.", F.col("ReportedInstitute")))
    size = Y.list_size(Y.json_records(F.col("hss_compartments"), ["COMPSubject"]))
    flagged = hss_students(t).withColumn("compartmental_status", F.lit("YES"))
    return ST.admitted_without_institute(options).select(F.lit("no institute").alias("kind"), "barcode").unionByName(
        ST.flagged_without_subjects(flagged, size).select(F.lit("no subjects").alias("kind"), "barcode"))


@query("hss_genders_by_year", _with(HSS, """SELECT academic_year AS "Year", COUNT(*) AS "Total", COUNT(*) FILTER (gender='Male') AS "Male", COUNT(*) FILTER (gender='Female') AS "Female", CAST(0 AS BIGINT) AS "Trans" FROM s GROUP BY 1"""))
def hss_genders_by_year(t):
    return ST.genders_by_year(hss_students(t))


@query("hss_results_by_gender", _with(HSS, """
SELECT academic_year AS "Year", COUNT(*) FILTER (compartmental_status='NO') AS "Passed", COUNT(*) FILTER (compartmental_status='YES') AS "Failed", COUNT(*) FILTER (gender='Male' AND compartmental_status='NO') AS "Male_Passed",
 COUNT(*) FILTER (gender='Male' AND compartmental_status='YES') AS "Male_Failed", COUNT(*) FILTER (gender='Female' AND compartmental_status='NO') AS "Female_Passed", COUNT(*) FILTER (gender='Female' AND compartmental_status='YES') AS "Female_Failed",
 CAST(0 AS BIGINT) AS "Trans_Passed", CAST(0 AS BIGINT) AS "Trans_Failed" FROM s GROUP BY 1"""))
def hss_results_by_gender(t):
    return ST.results_by_gender(hss_students(t))


@query("hss_results_overall", _with(HSS, """SELECT gender, COUNT(*) AS "Overall", COUNT(*) FILTER (compartmental_status='NO') AS "Passed", COUNT(*) FILTER (compartmental_status='YES') AS "Failed" FROM s GROUP BY 1"""))
def hss_results_overall(t):
    return ST.results_overall(hss_students(t))


@query("hss_low_performance", _with(HSS, """
SELECT academic_year, ROUND(100*COUNT(*) FILTER (gender='Female' AND percentage<33)::DOUBLE/COUNT(*) FILTER (gender='Female'),6) AS "Female", ROUND(100*COUNT(*) FILTER (gender='Male' AND percentage<33)::DOUBLE/COUNT(*) FILTER (gender='Male'),6) AS "Male" FROM s GROUP BY 1"""))
def hss_low_performance(t):
    return rounded(ST.low_performance(hss_students(t)), 6, "Female", "Male")


@query("hss_category_results", _with(HSS, """
SELECT upper(social_category) AS social_category, COUNT(*) AS "Total Count", COUNT(*) FILTER (compartmental_status='NO') AS "Passed", COUNT(*) FILTER (compartmental_status='YES') AS "Failed", ROUND(AVG(percentage),4) AS "Avg %",
 round_even(COUNT(*)::DOUBLE/SUM(COUNT(*)) OVER ()*100,2) AS "% of Total Students", round_even(COUNT(*) FILTER (compartmental_status='NO')::DOUBLE/COUNT(*)*100,2) AS "Pass Rate (%)",
 round_even(COUNT(*) FILTER (compartmental_status='YES')::DOUBLE/COUNT(*)*100,2) AS "Fail Rate (%)" FROM s GROUP BY 1"""))
def hss_category_results(t):
    return rounded(ST.category_results(hss_students(t)), 4, "Avg %")


@query("hss_category_stats", _with(HSS, """
SELECT upper(social_category) AS social_category, round_even(AVG(percentage),2) AS "Mean", round_even(STDDEV_SAMP(percentage),2) AS "Std", round_even(quantile_cont(percentage,0.25),2) AS "25th", round_even(quantile_cont(percentage,0.5),2) AS "Median",
 round_even(quantile_cont(percentage,0.75),2) AS "75th", COUNT(percentage) AS "Count", MIN(percentage) AS "Min", MAX(percentage) AS "Max" FROM s GROUP BY 1"""))
def hss_category_stats(t):
    return ST.category_stats(hss_students(t))


# --- identity -----------------------------------------------------------------------------------

@query("hss_admission_summary", sql("""
WITH o AS (SELECT academic_year, aadhar_no, status FROM people LEFT JOIN lines ON o_orderkey=l_orderkey WHERE module='HSS'), b AS (SELECT academic_year, aadhar_no,
 MAX(CASE status WHEN 'ADMITTED' THEN 4 WHEN 'TC TAKEN' THEN 3 WHEN 'SELECTED BUT NOT ADMITTED' THEN 2 WHEN 'NOT SELECTED' THEN 1 ELSE 0 END) AS r FROM o GROUP BY 1,2)
SELECT academic_year, (SELECT COUNT(*) FROM o WHERE o.academic_year=b.academic_year) AS applications, COUNT(*) FILTER (r=4) AS admitted, COUNT(*) FILTER (r=3) AS tc_taken, COUNT(*) FILTER (r=2) AS selected_but_not_admitted,
 COUNT(*) FILTER (r=1) AS not_selected, COUNT(*) FILTER (r=0) AS unknown FROM b GROUP BY 1""").replace("\nWITH o AS", ",\no AS"))
def hss_admission_summary(t):
    return ID.admission_summary(H.hss_applications_enriched(S.students(t, "HSS")))


@described_once
def identities(t):
    return ID.with_student_key(ID.marksheet_identity(S.students(t).where("sams_code is not null")), None)


@query("yearly_match", _with("""ky AS (SELECT academic_year AS yr, aadhar_no AS a, lower(student_name) || '_' || (year(p1.l_shipdate)-p1.l_linenumber+1) || '_' || dob || '_' ||
 CASE WHEN length(CAST(p1.l_partkey AS VARCHAR))=9 OR p1.l_linestatus<>'O' THEN CAST(p1.l_partkey AS VARCHAR) ELSE 'NA' END || '_' || p1.l_linestatus AS b FROM people JOIN line1 p1 ON o_orderkey=l_orderkey),
kp AS (SELECT *, COUNT(*) OVER (PARTITION BY yr,a) AS na, COUNT(*) OVER (PARTITION BY yr,b) AS nb FROM (SELECT DISTINCT * FROM ky))""", """
SELECT yr AS academic_year, (SELECT COUNT(*) FROM ky WHERE ky.yr=kp.yr) AS total_rows, (SELECT COUNT(*) FROM ky WHERE ky.yr=kp.yr) AS total_admitted, COUNT(DISTINCT a) AS aadhar_no_ids, COUNT(DISTINCT CASE WHEN na>1 THEN a END) AS aadhar_no_many,
 COUNT(DISTINCT b) AS student_key_ids, COUNT(DISTINCT CASE WHEN nb>1 THEN b END) AS student_key_many, COUNT(*) FILTER (na=1 AND nb=1) AS one_to_one FROM kp GROUP BY 1"""))
def yearly_match(t):
    return ID.yearly_match(identities(t).withColumn("admission_status", F.lit("Yes")))


@query("missing_by_year", sql("SELECT academic_year, COUNT(*) AS total, COUNT(*) FILTER (phase IS NULL OR FALSE) AS phase, CAST(0 AS BIGINT) AS gender FROM people GROUP BY 1"))
def missing_by_year(t):
    rows = S.people(t).withColumn("phase", F.trim("phase"))
    return ID.missing_by_year(rows, ["phase", "gender"])


@query("roll_coverage", sql("""
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (l_linestatus='O' AND length(CAST(l_partkey AS VARCHAR))<>9) AS "rows_with_NA", COUNT(*) FILTER (NOT (l_linestatus='O' AND length(CAST(l_partkey AS VARCHAR))<>9)) AS valid_rows FROM people JOIN line1 ON o_orderkey=l_orderkey"""))
def roll_coverage(t):
    return ID.roll_coverage(identities(t))


@query("person_roll_coverage", sql("""
SELECT COUNT(*) AS unique_aadhar, COUNT(*) FILTER (has) AS with_roll, COUNT(*) FILTER (NOT has) AS without_roll FROM (SELECT aadhar_no, bool_or(l_linestatus='F') AS has FROM people JOIN line1 ON o_orderkey=l_orderkey GROUP BY 1)"""))
def person_roll_coverage(t):
    return ID.person_roll_coverage(identities(t))


@query("problematic_keys", """
SELECT l_orderkey, l_linenumber, l_suppkey, dup_count, unique_aadhar_count FROM (SELECT *, COUNT(*) OVER (PARTITION BY l_partkey, l_linenumber) AS dup_count FROM lineitem) JOIN
 (SELECT l_partkey, l_linenumber, COUNT(DISTINCT l_suppkey) AS unique_aadhar_count FROM lineitem GROUP BY 1,2) USING (l_partkey, l_linenumber) WHERE dup_count>1 AND unique_aadhar_count>1""")
def problematic_keys(t):
    rows = t.lineitem.withColumn("student_key", F.concat_ws("_", "l_partkey", "l_linenumber"))
    return ID.problematic_keys(rows, "student_key", "l_suppkey").select("l_orderkey", "l_linenumber", "l_suppkey", "dup_count", "unique_aadhar_count")


@query("person_diagnostics", sql("""
SELECT module, COUNT(*) AS total, CAST(0 AS BIGINT) AS missing, COUNT(DISTINCT aadhar_no) AS "unique", COUNT(*)-COUNT(DISTINCT aadhar_no) AS duplicates FROM people WHERE module<>'PDIS' GROUP BY 1"""))
def person_diagnostics(t):
    return ID.person_diagnostics(S.people(t))


@query("students_by_module", sql("""
SELECT academic_year, i AS "ITI", d AS "Diploma", p AS "PDIS", i+d+p AS "Total", u AS "Unique" FROM (SELECT academic_year, COUNT(DISTINCT aadhar_no) FILTER (module='ITI') AS i, COUNT(DISTINCT aadhar_no) FILTER (module='Diploma') AS d,
 COUNT(DISTINCT barcode) FILTER (module='PDIS') AS p, COUNT(DISTINCT CASE WHEN module='PDIS' THEN barcode ELSE aadhar_no END) AS u FROM people WHERE module IN ('ITI','Diploma','PDIS') GROUP BY 1)"""))
def students_by_module(t):
    return ID.students_by_module(S.people(t), ["ITI", "Diploma", "PDIS"])


@query("status_by_year", sql("""
SELECT academic_year, i_u AS iti_unique_applicant, i_a AS iti_admitted, CAST(0 AS BIGINT) AS iti_tc_taken, i_u-i_a AS iti_not_admitted, i_t AS iti_total_applications FROM (SELECT academic_year, COUNT(*) AS i_u, COUNT(*) FILTER (st='F') AS i_a, SUM(k)::BIGINT AS i_t FROM
 (SELECT academic_year, aadhar_no, arg_min(o_orderstatus, barcode) AS st, SUM(k) AS k FROM (SELECT academic_year, aadhar_no, barcode, o_orderstatus, (SELECT COUNT(*) FROM lineitem WHERE l_orderkey=o_orderkey) AS k FROM people WHERE module='ITI') GROUP BY 1,2) GROUP BY 1)"""))
def status_by_year(t):
    rows = S.of_module(S.people(t), "ITI").withColumn("admission_status", F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No"))
    applications = VO.applications(S.students(t, "ITI")).where("option_no is not null")
    return ID.application_status_by_year(rows, applications, "iti")


# --- districts and groups -------------------------------------------------------------------------

@query("leavers_by_district", sql(f"SELECT district, COUNT(*) AS total_students, COUNT(*) FILTER (NOT local) AS students_outside, ROUND(100*COUNT(*) FILTER (NOT local)::DOUBLE/COUNT(*),6) AS percentage_outside FROM {DIPLOMA} GROUP BY 1"))
def leavers_by_district(t):
    return rounded(DT.leavers(diploma(t)), 6, "percentage_outside")


TOP_LEAVING = f"""lv AS (SELECT district, COUNT(*) FILTER (NOT local)::DOUBLE/COUNT(*) AS pct FROM {ITI} AND academic_year=2023 GROUP BY 1), tl AS (SELECT district FROM lv QUALIFY RANK() OVER (ORDER BY pct DESC)<=10)"""


@query("flows_from_top_leaving", _with(TOP_LEAVING, f"SELECT district, institute_district, COUNT(*) AS n FROM {ITI} AND academic_year=2023 AND district IN (SELECT district FROM tl) GROUP BY 1,2"))
def flows_from_top_leaving(t):
    rows = ET.in_year(iti(t))
    return DT.flows_from(rows, DT.top_leaving(rows))


@query("incoming_students", sql(f"SELECT institute_district, COUNT(*) AS total_incoming_students FROM {DIPLOMA} AND NOT local GROUP BY 1"))
def incoming_students(t):
    return DT.incoming(diploma(t))


@query("female_net_migration", sql(f"""
SELECT place, COALESCE(o,0) AS outgoing, COALESCE(i,0) AS incoming, COALESCE(o,0)-COALESCE(i,0) AS net, CASE WHEN COALESCE(o,0)>COALESCE(i,0) THEN 'loses' WHEN COALESCE(o,0)<COALESCE(i,0) THEN 'gains' ELSE 'even' END AS direction FROM
 (SELECT district AS place, COUNT(*) AS o FROM {DIPLOMA} AND gender='Female' AND NOT local GROUP BY 1) FULL OUTER JOIN (SELECT institute_district AS place, COUNT(*) AS i FROM {DIPLOMA} AND gender='Female' AND NOT local GROUP BY 1) USING (place)"""))
def female_net_migration(t):
    return DT.migration(diploma(t).where("gender = 'Female'"))


@query("institutes_per_capita", sql(f"""
SELECT i.district, i."Govt.", i."Pvt.", total_itis, population, round_even(total_itis*1e6/population,1) AS per_capita FROM (SELECT CASE institute_district WHEN 'NATION_0' THEN 'NATION_ZERO' ELSE institute_district END AS district,
 COUNT(DISTINCT reported_institute) FILTER (type_of_institute='Govt.') AS "Govt.", COUNT(DISTINCT reported_institute) FILTER (type_of_institute='Pvt.') AS "Pvt.", COUNT(DISTINCT reported_institute) AS total_itis FROM {ITI} AND academic_year=2023 GROUP BY 1) i
LEFT JOIN (SELECT CASE n_name WHEN 'NATION_0' THEN 'NATION_ZERO' ELSE n_name END AS district, COUNT(*) AS population FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1) p USING (district)"""))
def institutes_per_capita(t):
    renamed = F.when(F.col("n_name") == "NATION_0", "NATION_ZERO")
    aliases = t.nation.select(F.col("n_name").alias("alias"), renamed.alias("canonical")).where("canonical is not null")
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    population = people.groupBy(F.coalesce(renamed, F.col("n_name")).alias("district")).agg(F.count(F.lit(1)).alias("population"))
    return DT.institutes_per_capita(ET.in_year(iti(t)), population, aliases)


@query("type_shares", sql(f"""
SELECT academic_year, COUNT(*) AS total_students, COUNT(*) FILTER (type_of_institute='Pvt.') AS pvt_students, COUNT(*) FILTER (type_of_institute='Govt.') AS gov_students,
 ROUND(COUNT(*) FILTER (type_of_institute='Pvt.')::DOUBLE/COUNT(*)*100,2) AS share_of_pvt, ROUND(COUNT(*) FILTER (type_of_institute='Govt.')::DOUBLE/COUNT(*)*100,2) AS share_of_gov FROM {ITI} GROUP BY 1"""))
def type_shares(t):
    return DT.type_shares(iti(t))


@query("institute_counts", sql(f"""
SELECT academic_year, COUNT(DISTINCT reported_institute) AS total_institutes, COUNT(DISTINCT reported_institute) FILTER (type_of_institute='Govt.') AS gov_institutes, COUNT(DISTINCT reported_institute) FILTER (type_of_institute='Pvt.') AS pvt_institutes FROM {ITI} GROUP BY 1"""))
def institute_counts(t):
    return DT.institute_counts(iti(t))


@query("female_counts", sql(f"""
SELECT academic_year, COUNT(*) AS total_students, COUNT(*) FILTER (gender='Female') AS female_students, COUNT(*) FILTER (gender='Male') AS male_students, ROUND(COUNT(*) FILTER (gender='Female')::DOUBLE/COUNT(*)*100,1) AS female_percentage FROM {ITI} GROUP BY 1"""))
def female_counts(t):
    return DT.female_counts(iti(t), ["academic_year"])


BANDS = f"""fy AS (SELECT reported_institute, academic_year, COUNT(*) AS total, COUNT(*) FILTER (gender='Female')::DOUBLE/COUNT(*)*100 AS pct FROM {ITI} AND type_of_institute='Govt.' GROUP BY 1,2),
fb AS (SELECT reported_institute, CASE WHEN pct<=20 THEN 'Between 0 to 20' WHEN pct<=30 THEN 'Between 20 to 30' WHEN pct<=40 THEN 'Between 30 to 40' WHEN pct<=50 THEN 'Between 40 to 50' ELSE 'Between 50 to 60' END AS band FROM fy WHERE academic_year=2023 AND pct>0)"""


@query("female_band_counts", _with(BANDS, "SELECT academic_year, band, COUNT(*) AS institutes FROM fy JOIN fb USING (reported_institute) GROUP BY 1,2"))
def female_band_counts(t):
    return DT.band_counts(iti(t).where("type_of_institute = 'Govt.'"))


@query("largest_institutes_over_time", _with(BANDS, "SELECT reported_institute, academic_year, total AS total_students, ROUND(pct,6) AS female_percentage FROM fy WHERE reported_institute IN (SELECT reported_institute FROM fy WHERE academic_year=2023 QUALIFY RANK() OVER (ORDER BY total DESC)<=5)"))
def largest_institutes(t):
    rows = DT.largest_over_time(iti(t).where("type_of_institute = 'Govt.'"))
    return rounded(rows.select("reported_institute", "academic_year", "total_students", "female_percentage"), 6, "female_percentage")


@query("mean_female_share", sql(f"""
SELECT academic_year, type_of_institute, ROUND(AVG(100*f::DOUBLE/n),6) AS mean_female_share, ROUND(100*SUM(f)::DOUBLE/SUM(n),6) AS aggr_female_share FROM (SELECT academic_year, type_of_institute, reported_institute, COUNT(*) AS n, COUNT(*) FILTER (gender='Female') AS f FROM {ITI} GROUP BY 1,2,3) GROUP BY 1,2"""))
def mean_female_share(t):
    return rounded(DT.mean_female_share(iti(t)), 6, "mean_female_share", "aggr_female_share")


@query("social_group_shares", sql(f"""SELECT gender, social_category, COUNT(*) AS count, ROUND(100*COUNT(*)::DOUBLE/SUM(COUNT(*)) OVER (PARTITION BY gender),1) AS "Percentage" FROM {ITI} AND academic_year=2023 GROUP BY 1,2"""))
def social_group_shares(t):
    return DT.group_shares(ET.in_year(iti(t)), "social_category", ["gender"])


@query("income_group_shares", sql(f"""
WITH c AS (SELECT CASE WHEN annual_income IN ('2,50,000-8,00,000','Above 8,00,000') THEN '2,50,000 and Above' ELSE annual_income END AS annual_income, COUNT(*) AS count FROM {DIPLOMA} AND academic_year=2023 AND annual_income<>'OTHER' GROUP BY 1)
SELECT *, ROUND(100*count::DOUBLE/SUM(count) OVER (),1) AS share FROM c""").replace("\nWITH c AS", ",\nc AS"))
def income_group_shares(t):
    return DT.income_shares(ET.in_year(diploma(t)), {"2,50,000 and Above": INCOMES[1:3]}, ["OTHER"])


@query("top_trades_with_ties", sql(f"""
SELECT gender, reported_branch_or_trade, course_period, student_count FROM (SELECT gender, reported_branch_or_trade, course_period, COUNT(*) AS student_count FROM {ITI} AND academic_year=2023 GROUP BY 1,2,3) QUALIFY RANK() OVER (PARTITION BY gender ORDER BY student_count DESC)<=10"""))
def top_trades_with_ties(t):
    return DT.top_trades_with_ties(ET.in_year(iti(t)))


@query("institute_trade_matrix", sql(f"""
SELECT reported_institute, COUNT(*) FILTER (reported_branch_or_trade='Brand#1') AS "Brand#1", COUNT(*) FILTER (reported_branch_or_trade='Brand#12') AS "Brand#12" FROM {ITI} GROUP BY 1"""))
def institute_trade_matrix(t):
    return DT.trade_matrix(iti(t), ["Brand#1", "Brand#12"])


@query("core_trade_shares", sql(f"""
SELECT academic_year, type_of_institute, COUNT(*) AS total_students, COUNT(*) FILTER (gender='Female') AS female_students, COUNT(*) FILTER (gender='Male') AS male_students, ROUND(COUNT(*) FILTER (gender='Female')::DOUBLE/COUNT(*)*100,1) AS female_percentage
FROM {ITI} AND reported_branch_or_trade IN ('Brand#1','Brand#12','Brand#23') GROUP BY 1,2"""))
def core_trade_shares(t):
    return DT.core_trade_shares(iti(t), ["Brand#1", "Brand#12", "Brand#23"])


@query("mean_marks_by_year_gender", sql("""
SELECT academic_year, gender, ROUND(AVG(percentage),4) AS mean_marks, COUNT(percentage) AS n FROM people WHERE module='HSS' GROUP BY 1,2"""))
def mean_marks(t):
    return rounded(DT.mean_marks(hss_students(t), ["academic_year", "gender"]), 4, "mean_marks")


@query("district_populations", sql("""
SELECT upper(substr(n_name,1,1)) || lower(substr(n_name,2)) AS district, COUNT(*)*10 AS population FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1""").replace(S.CTES.strip(), "z AS (SELECT 1)"))
def district_populations(t):
    villages = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("District"), F.lit("10").alias("Vill Population+"))
    return VO.district_populations(villages)


# --- statistics ------------------------------------------------------------------------------------

def t_tail(t: str, v: str) -> str:
    """Two-sided probability of t with v degrees of freedom, by Simpson's rule."""
    density = f"exp(lgamma(({v}+1)/2)-lgamma({v}/2)-({v}+1)/2*ln(1+pow(h*i,2)/{v}))/sqrt({v}*pi())"
    return f"""(SELECT greatest(0, 1-2*SUM((CASE WHEN i IN (0,4000) THEN 1 WHEN i%2=1 THEN 4 ELSE 2 END)*h/3*{density}))
  FROM (SELECT i, least(abs({t}),40)/4000 AS h FROM range(4001) r(i)))"""


def f_tail(f: str, a: str, b: str) -> str:
    """Probability of an F above f, by Simpson's rule over its logarithm."""
    density = f"exp({a}/2*ln({a})+{b}/2*ln({b})+{a}/2*u-({a}+{b})/2*ln({b}+{a}*exp(u))+lgamma(({a}+{b})/2)-lgamma({a}/2)-lgamma({b}/2))"
    return f"""(SELECT SUM((CASE WHEN i IN (0,4000) THEN 1 WHEN i%2=1 THEN 4 ELSE 2 END)*h/3*{density})
  FROM (SELECT i, h, ln({f})+i*h AS u FROM (SELECT i, 30*sqrt(2/{a}+2/{b})/4000 AS h FROM range(4001) r(i))))"""


@query("welch_t", f"""
WITH m AS (SELECT AVG(o_totalprice) FILTER (c_mktsegment='BUILDING') AS mean_1, VAR_SAMP(o_totalprice) FILTER (c_mktsegment='BUILDING') AS var_1, COUNT(*) FILTER (c_mktsegment='BUILDING') AS n_1,
 AVG(o_totalprice) FILTER (c_mktsegment='MACHINERY') AS mean_2, VAR_SAMP(o_totalprice) FILTER (c_mktsegment='MACHINERY') AS var_2, COUNT(*) FILTER (c_mktsegment='MACHINERY') AS n_2 FROM orders JOIN customer ON o_custkey=c_custkey),
w AS (SELECT *, (mean_1-mean_2)/sqrt(var_1/n_1+var_2/n_2) AS t, pow(var_1/n_1+var_2/n_2,2)/(pow(var_1/n_1,2)/(n_1-1)+pow(var_2/n_2,2)/(n_2-1)) AS df, var_1/var_2 AS f, (n_1-1)::DOUBLE AS d1, (n_2-1)::DOUBLE AS d2 FROM m),
x AS (SELECT *, {t_tail("w.t", "w.df")} AS p, {f_tail("w.f", "w.d1", "w.d2")} AS above FROM w)
SELECT ROUND(mean_1,3) AS mean_1, n_1, ROUND(mean_2,3) AS mean_2, n_2, ROUND(t,6) AS t, ROUND(df,3) AS df, ROUND(f,6) AS f_ratio, ROUND(p,6) AS p_value, ROUND(2*least(above,1-above),6) AS f_p_value FROM x""")
def welch_t(t):
    from rollbook.operators.stats import welch_t as test

    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    out = test(rows, "c_mktsegment", "o_totalprice", "BUILDING", "MACHINERY").drop("var_1", "var_2")
    return rounded(rounded(out, 6, "t", "f_ratio", "p_value", "f_p_value"), 3, "mean_1", "mean_2", "df")


@query("trend", """
SELECT o_orderpriority, ROUND(regr_slope(o_totalprice, year(o_orderdate)),4) AS slope, ROUND(regr_intercept(o_totalprice, year(o_orderdate)),0) AS intercept, COUNT(*) AS n FROM orders GROUP BY 1""")
def trend(t):
    from rollbook.operators.stats import trend as fit

    out = fit(t.orders.withColumn("yr", F.year("o_orderdate")), ["o_orderpriority"], "yr", "o_totalprice")
    return rounded(rounded(out, 4, "slope"), 0, "intercept")


@query("ols", """
WITH g AS (SELECT c_mktsegment AS s, COUNT(*) AS n, AVG(o_totalprice) AS m, VAR_SAMP(o_totalprice)*(COUNT(*)-1) AS sse FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1),
v AS (SELECT SUM(sse)/(SUM(n)-COUNT(*)) AS v FROM g), r AS (SELECT m AS rm, n AS rn FROM g WHERE s='BUILDING'),
c AS (SELECT CASE WHEN s='BUILDING' THEN '(intercept)' ELSE 'c_mktsegment=' || s END AS term, CASE WHEN s='BUILDING' THEN m ELSE m-rm END AS coefficient,
 sqrt(v*(CASE WHEN s='BUILDING' THEN 1.0::DOUBLE/n ELSE 1.0::DOUBLE/n+1.0::DOUBLE/rn END)) AS std_error FROM g, v, r)
SELECT term, ROUND(coefficient,2) AS coefficient, ROUND(std_error,3) AS std_error, ROUND(coefficient/std_error,4) AS t FROM c""")
def ols_one_factor(t):
    from rollbook.operators.stats import ols

    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    out = ols(rows, "o_totalprice", ["c_mktsegment"], {"c_mktsegment": "BUILDING"}).select("term", "coefficient", "std_error", "t")
    return rounded(rounded(rounded(out, 2, "coefficient"), 3, "std_error"), 4, "t")


@query("ols_residuals", """
SELECT 'c_mktsegment' AS factor, c_mktsegment AS level, 0.0::DOUBLE AS residual FROM customer JOIN orders ON o_custkey=c_custkey GROUP BY ALL
UNION ALL SELECT 'o_orderstatus', o_orderstatus, 0.0::DOUBLE FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY ALL
UNION ALL SELECT 'o_orderpriority', o_orderpriority, 0.0::DOUBLE FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY ALL""")
def ols_residuals(t):
    """Mean residual per level of three factors; least squares makes each of them zero."""
    from rollbook.operators.stats import ols

    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    reference = {"c_mktsegment": "BUILDING", "o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    fitted = ols(rows, "o_totalprice", list(reference), reference).select("term", "coefficient")
    # One map of a coefficient per level, as a scalar subquery.
    terms = fitted.agg(F.map_from_entries(F.collect_list(F.struct("term", "coefficient")))).scalar()
    effect = lambda name: F.coalesce(F.try_element_at("_c", F.concat(F.lit(f"{name}="), F.col(name))), F.lit(0.0))
    guess = F.try_element_at("_c", F.lit("(intercept)")) + sum((effect(n) for n in reference), F.lit(0.0))
    left = rows.withColumn("_c", terms).withColumn("residual", F.col("o_totalprice") - guess)
    levels = F.explode(F.array(*[F.struct(F.lit(n).alias("factor"), F.col(n).alias("level")) for n in reference]))
    means = left.select(levels.alias("x"), "residual").groupBy("x.factor", "x.level").agg(F.avg("residual").alias("residual"))
    return means.withColumn("residual", F.abs(F.round("residual", 3)))


@query("ols_nested", f"""
WITH RECURSIVE cells AS (SELECT c_mktsegment AS a, o_orderstatus AS b, o_orderpriority AS c, COUNT(*)::DOUBLE AS n, SUM(o_totalprice)::DOUBLE AS s, VAR_POP(o_totalprice)*COUNT(*) AS within FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1,2,3),
lv AS (SELECT DISTINCT 1 AS f, 'c_mktsegment=' || a AS term FROM cells WHERE a<>'BUILDING' UNION SELECT 2, 'o_orderstatus=' || b FROM cells WHERE b<>'F' UNION SELECT 3, 'o_orderpriority=' || c FROM cells WHERE c<>'1-URGENT'),
tm AS (SELECT model, row_number() OVER (PARTITION BY model ORDER BY f, term) AS i, term FROM (SELECT 0 AS f, '(intercept)' AS term UNION ALL SELECT * FROM lv), range(1,4) r(model) WHERE f<=model),
x AS (SELECT model, i, term, a, b, c, n, s, (term IN ('(intercept)', 'c_mktsegment=' || a, 'o_orderstatus=' || b, 'o_orderpriority=' || c))::DOUBLE AS x FROM cells, tm),
xx AS (SELECT p.model, p.i, q.i AS j, SUM(p.n*p.x*q.x) AS v FROM x p JOIN x q USING (model,a,b,c) GROUP BY ALL),
xy AS (SELECT model, i, SUM(s*x) AS v FROM x GROUP BY ALL),
m AS (SELECT model, i, list(v ORDER BY j) AS r, COUNT(*) AS w FROM xx GROUP BY 1,2),
g(model, k, r) AS (SELECT model, 1, list(m.r || [xy.v] || list_transform(range(1,w+1), lambda z: CASE WHEN z=i THEN 1.0::DOUBLE ELSE 0.0 END) ORDER BY i) FROM m JOIN xy USING (model,i) GROUP BY model
 UNION ALL SELECT model, k+1, list_transform(r, lambda y, i: CASE WHEN i=k THEN list_transform(y, lambda v: v/r[k][k]) ELSE list_transform(y, lambda v, j: v-y[k]/r[k][k]*r[k][j]) END) FROM g WHERE k<=len(r)),
e AS (SELECT model, i, term, r[i][len(r)+1] AS coefficient, r[i][len(r)+1+i] AS inv, len(r) AS w FROM g JOIN tm USING (model) WHERE k=len(r)+1),
fit AS (SELECT model, a, b, c, SUM(x*coefficient) AS u FROM x JOIN e USING (model,i) GROUP BY ALL),
rest AS (SELECT model, SUM(within+n*pow(s/n-u,2)) AS rss, SUM(n) AS n FROM fit JOIN cells USING (a,b,c) GROUP BY 1),
o AS (SELECT model, term, coefficient, sqrt(inv*rss/(n-w)) AS std_error, n-w AS v FROM e JOIN rest USING (model)),
q AS (SELECT *, coefficient/std_error AS t FROM o)
SELECT term, ROUND(coefficient,2) AS coefficient, ROUND(std_error,3) AS std_error, ROUND(t,4) AS t, ROUND({t_tail("q.t", "q.v")},6) AS p_value, CAST(model AS INTEGER) AS model FROM q""")
def ols_nested(t):
    """Three nested models against the normal equations solved by elimination."""
    from rollbook.operators.stats import ols

    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    reference = {"c_mktsegment": "BUILDING", "o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    names = list(reference)
    parts = [ols(rows, "o_totalprice", names[: i + 1], reference).withColumn("model", F.lit(i + 1)) for i in range(3)]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rounded(rounded(rounded(rounded(out, 2, "coefficient"), 3, "std_error"), 4, "t"), 6, "p_value")


@query("did_columns", """
SELECT o_orderkey, CAST(year(o_orderdate)>=1998 AS INTEGER) AS post, CAST(o_orderpriority='1-URGENT' AS INTEGER) AS treatment, CAST(year(o_orderdate)>=1998 AND o_orderpriority='1-URGENT' AS INTEGER) AS post_treatment FROM orders""")
def did_columns(t):
    from rollbook.operators.stats import did_columns as flags

    return flags(t.orders.withColumn("yr", F.year("o_orderdate")), "yr", 1998, "o_orderpriority", ["1-URGENT"]).select("o_orderkey", "post", "treatment", "post_treatment")


@query("histogram_density", "SELECT CAST(floor(o_totalprice/20000)*20000 AS DOUBLE) AS bin, COUNT(*) AS n, ROUND(COUNT(*)::DOUBLE/(SUM(COUNT(*)) OVER ()*20000),12) AS density FROM orders GROUP BY 1")
def histogram_density(t):
    from rollbook.operators.stats import histogram_density as table

    return rounded(table(t.orders, "o_totalprice", 20000), 12, "density")


@query("density", """
WITH m AS (SELECT o_orderstatus AS g, stddev_samp(o_totalprice) AS sd, MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi, COUNT(*) AS n, quantile_cont(o_totalprice,0.25) AS q1, quantile_cont(o_totalprice,0.75) AS q3 FROM orders GROUP BY 1),
h AS (SELECT *, LEAST(sd,(q3-q1)/1.34)*0.9*pow(n,-0.2) AS bw FROM m), s AS (SELECT *, lo-3*bw AS f, (hi-lo+6*bw)/511 AS step FROM h),
w AS (SELECT g, n, bw, f, step, CAST(round((o_totalprice-f)/step) AS INTEGER) AS c, COUNT(*) AS w FROM orders JOIN s ON o_orderstatus=g GROUP BY ALL),
x AS (SELECT UNNEST(range(512)) AS i)
SELECT g AS o_orderstatus, ROUND(f+i*step,3) AS x, ROUND(SUM(w*exp(-0.5*pow((i-c)*step/bw,2)))/(n*bw*sqrt(2*pi())),12) AS density FROM w, x GROUP BY g, i, f, step, n, bw""")
def density(t):
    from rollbook.operators.stats import kernel_density

    return rounded(rounded(kernel_density(t.orders, "o_totalprice", ["o_orderstatus"]), 12, "density"), 3, "x")
