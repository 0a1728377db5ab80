"""Student and institute records that Spark derives from the order tables.

Every order is one application, its customer the student, its line items the
listed options and marksheets; suppliers are institutes and brands are trades.
``CTES`` says the same in SQL, without any JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from queries.base import Tables, described_once
from rollbook.operators.joins import perhaps_among

MODULES = {"1-URGENT": "ITI", "2-HIGH": "Diploma", "3-MEDIUM": "HSS", "4-NOT SPECIFIED": "DEG", "5-LOW": "PDIS"}
CATEGORIES = {"BUILDING": "General", "AUTOMOBILE": "SC", "MACHINERY": "ST", "HOUSEHOLD": "OBC/SEBC", "FURNITURE": "Other"}
LEVELS = {"ECONOMY": "B.A.", "LARGE": "Diploma (Civil)", "MEDIUM": "ITI", "PROMO": "Matric", "SMALL": "CHSE"}
STREAMS = {"A": "Arts", "N": "Commerce", "R": "Science"}
STATUSES = {"AF": "ADMITTED", "AO": "SELECTED BUT NOT ADMITTED", "RF": "TC TAKEN", "RO": "NOT SELECTED", "NO": "NOT SELECTED"}
LINE_ORDER = ["l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice"]


def _case(col, table: dict[str, str]):
    out = None
    for k, v in table.items():
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out


def _with_places(t: Tables, items: DataFrame) -> DataFrame:
    """Line items with the rows of their institute and trade, as they are given.

    One table is joined after the other: Spark knows the size of a table, but not of a join, and would shuffle all items for it.
    Parts come first: they are the most, and where they are not broadcast, items are shuffled for them without any names.
    """
    found = items.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return found.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))


def _kind(balance):
    return F.when(balance >= 5000, "Govt.").otherwise("Pvt.")


def lines(t: Tables) -> DataFrame:
    """Line items with their institute and trade."""
    return _with_places(t, t.lineitem).select(
        *t.lineitem.columns, F.concat(F.lit("ITI "), "s_name").alias("inst"), F.col("n_name").alias("inst_district"),
        _kind(F.col("s_acctbal")).alias("kind"), "p_brand", "p_type", "p_size",
        F.concat(F.lit("S"), "l_suppkey").alias("inst_id"), _case(F.col("l_returnflag"), STREAMS).alias("stream"),
        _case(F.concat("l_returnflag", "l_linestatus"), STATUSES).alias("status"),
    )


@described_once
def people(t: Tables) -> DataFrame:
    """One row per application without its payloads."""
    home = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(home, F.col("c_nationkey") == F.col("n_nationkey"))
    price, balance = F.col("o_totalprice"), F.col("c_acctbal")
    yes = lambda c: F.when(c, "Yes").otherwise("No")
    return rows.select(
        "o_orderkey", F.concat(F.lit("B"), "o_orderkey").alias("barcode"), F.concat(F.lit("A"), "o_custkey").alias("aadhar_no"),
        (F.year("o_orderdate") + 22).alias("academic_year"), (F.year("o_orderdate") + 22).alias("year"),
        _case(F.col("o_orderpriority"), MODULES).alias("module"), F.col("c_name").alias("student_name"),
        F.when(balance < 5000, "Female").otherwise("Male").alias("gender"),
        F.date_format(F.date_sub("o_orderdate", 6570), "yyyy-MM-dd").alias("dob"),
        _case(F.col("c_mktsegment"), CATEGORIES).alias("social_category"), F.col("n_name").alias("district"),
        F.col("r_name").alias("state"), F.concat(F.lit("Block "), "c_mktsegment").alias("block"),
        F.concat("c_name", F.lit(", Old Town")).alias("address"), F.concat(F.lit("75"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0")).alias("pin_code"),
        F.when(price < 100000, "Upto 2.5 lakh").when(price < 300000, "Between 2.5 To 8 lakh").when(price < 450000, "Above 8 lakh").otherwise("--").alias("annual_income"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "2").otherwise(" ").alias("phase"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_of_application"),
        yes(price > 490000).alias("orphan"), F.when(price < 20000, "NA").otherwise(yes(price < 30000)).alias("gc"), yes(price < 40000).alias("ph"),
        yes(balance > 9500).alias("es"), yes(balance > 9000).alias("ews"), F.lit("No").alias("sports"),
        F.lit("No").alias("national_cadet_corps"), F.lit("No").alias("pm_care"), F.lit("NA").alias("had_two_year_full_time_work_exp_after_tenth"),
        F.round(price / 4500, 2).cast("string").alias("percentage"), F.floor(price / 1000).cast("string").alias("secured_marks"),
        F.lit("500").alias("total_marks"), F.year("o_orderdate").cast("string").alias("year_of_passing"),
        F.lit("Indian").alias("nationality"), "o_orderstatus",
    )


@described_once
def students(t: Tables, module: str | None = None) -> DataFrame:
    """The raw student table, or one module of it: text columns, and JSON lists built from the line items.

    A filter of a module's applications thins line items out first, so that few others are shuffled. An item is gathered as given values; the names and texts made of them are added to the gathered list.
    """
    who, taken = people(t), t.lineitem.select(
        "l_orderkey", *LINE_ORDER, "l_returnflag", "l_linestatus", "l_tax", "l_quantity", F.year("l_shipdate").alias("shipped"))
    if module is not None:
        who = who.where(F.col("module") == module)
        taken = perhaps_among(taken, "l_orderkey", t.orders.where(_case(F.col("o_orderpriority"), MODULES) == module), "o_orderkey")
    # Items go to their application as given; the names of their institute and trade are found there and not shuffled. The
    # number of partitions is fixed, as rows grow wide after the shuffle and Spark would merge partitions by their bytes in it.
    taken = taken.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    given = F.struct(
        *LINE_ORDER, "s_name", "n_name", F.col("s_acctbal"), "p_brand", "p_type", "p_size", "l_returnflag", "l_linestatus", "l_tax", "l_quantity", "shipped")
    item = lambda x: F.struct(
        *[x[c].alias(c) for c in LINE_ORDER], F.concat(F.lit("ITI "), x["s_name"]).alias("inst"), x["n_name"].alias("inst_district"),
        _kind(x["s_acctbal"]).alias("kind"), *[x[c].alias(c) for c in ("p_brand", "p_type", "p_size")],
        F.concat(F.lit("S"), x["l_suppkey"]).alias("inst_id"), _case(x["l_returnflag"], STREAMS).alias("stream"),
        _case(F.concat(x["l_returnflag"], x["l_linestatus"]), STATUSES).alias("status"),
        *[x[c].alias(c) for c in ("l_returnflag", "l_linestatus", "l_tax", "l_quantity", "shipped")])
    head = F.struct(*LINE_ORDER, "s_name", "n_name", _kind(F.col("s_acctbal")).alias("kind"), "p_brand", "p_type", "p_size")
    # An order has a handful of line items, so its list is short. The first item and the failed mark stand beside the list:
    # a query that reads no list shuffles only what they are made of.
    grouped = _with_places(t, taken).groupBy("l_orderkey").agg(
        F.min(head).alias("_h"), F.bool_or(F.col("l_returnflag") == "R").alias("_failed"), F.collect_list(given).alias("_g"))
    joined = who.join(grouped, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    rows = joined.withColumn("_l", F.array_sort(F.transform("_g", item))).drop("_g")
    first = F.col("_h")
    year = F.col("academic_year").cast("string")
    exam = lambda x: F.when(x["l_returnflag"] == "A", F.when(F.col("module") == "ITI", "10th Pass").otherwise("10th")).when(
        x["l_returnflag"] == "N", "+2 Science").otherwise("ITI")
    mark = lambda x: F.struct(
        exam(x).alias("ExamName"), (x["shipped"] - x["l_linenumber"] + 1).cast("string").alias("YearofPassing"),
        x["l_partkey"].cast("string").alias("RollNo"), F.lit("50").alias("TotalMarks"), x["l_quantity"].cast("int").cast("string").alias("SecuredMarks"),
        F.when(x["l_linestatus"] == "O", "BSE, ODISHA").otherwise("CBSE").alias("HighestQualificationExamBoard"),
        F.when(x["l_tax"] > 0.06, "Yes").otherwise("No").alias("CompartmentalStatus"), F.lit("Annual").alias("ExaminationType"))
    option = lambda x: F.struct(
        x["l_linenumber"].cast("string").alias("Option_No"), F.lit("1").alias("Phase"), x["inst"].alias("Institute_Name"),
        x["p_brand"].alias("Trade"), x["status"].alias("Status"))
    choice = lambda x: F.struct(
        x["l_linenumber"].cast("string").alias("OptionNo"), year.alias("Year"), F.lit("1").alias("Phase"), x["inst_id"].alias("SAMSCode"),
        x["inst"].alias("ReportedInstitute"), x["stream"].alias("Stream"), x["p_type"].alias("Subject"), x["inst_district"].alias("InstituteDistrict"),
        x["kind"].alias("TypeofInstitute"), x["status"].alias("AdmissionStatus"))
    subject = lambda x: F.struct(
        x["p_type"].alias("COMPSubject"), x["l_quantity"].cast("int").cast("string").alias("COMPFailMark"), F.lit("30").alias("COMPPassMark"))
    failed = F.filter("_l", lambda x: x["l_returnflag"] == "R")
    # Applications without line items show every way a payload can be empty.
    empty = F.when(F.col("o_orderstatus") == "F", "[]").when(F.col("o_orderstatus") == "O", "null")
    text = lambda build, of="_l": F.coalesce(F.to_json(F.transform(of, build)), empty)
    return rows.select(
        *[c for c in rows.columns if c not in ("_h", "_failed", "_l", "o_orderkey", "o_orderstatus")],
        F.concat(F.lit("S"), first["l_suppkey"]).alias("sams_code"), F.concat(F.lit("ITI "), first["s_name"]).alias("reported_institute"),
        first["p_brand"].alias("reported_branch_or_trade"), first["n_name"].alias("institute_district"), first["kind"].alias("type_of_institute"),
        F.when(first["p_size"] <= 25, "1 Year").otherwise("2 Years").alias("course_period"),
        _case(first["p_type"], LEVELS).alias("highest_qualification"),
        F.when(F.col("_failed"), "YES").otherwise("NO").alias("compartmental_status"),
        text(mark).alias("mark_data"), text(option).alias("option_data"), text(choice).alias("hss_option_details"),
        text(choice).alias("deg_option_details"), text(subject, failed).alias("hss_compartments"), text(subject, failed).alias("deg_compartments"),
    )


@described_once
def institutes(t: Tables, module: str | None = None) -> DataFrame:
    """The raw institute table, or one module of it: one row per institute, trade and year."""
    years = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.year("o_orderdate") + 22).alias("academic_year"))
    of_trade = F.when(F.col("p_brand") < "Brand#2", "ITI").otherwise("Diploma")
    trades = t.part if module is None else t.part.where(of_trade == module)
    code = F.concat(F.lit("S"), "l_suppkey")
    # Readers that join institutes by code and trade ask for both. Asked for here, where no others remain, all passes over the
    # items are one plan, so their shuffle is made once.
    placed = t.lineitem.where(F.col("l_suppkey").isNotNull() & code.isNotNull())
    trades = trades.where(F.col("p_brand").isNotNull()) if module == "ITI" else trades
    rows = placed.join(trades, F.col("l_partkey") == F.col("p_partkey")).join(years, "l_orderkey")
    count = lambda flag: F.count_if(F.col("l_returnflag") == flag)
    low = lambda flag, status: F.min(F.when((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status), F.col("l_quantity")).cast("int"))
    lowest = [f"{f}{s}" for f in "AN" for s in "FO"]
    # Items are counted by the institute's key; its names are joined to the counts, so that no item is shuffled with them.
    counted = rows.groupBy("l_suppkey", "p_brand", "academic_year").agg(
        F.count(F.lit(1)).alias("n_all"), *[count(f).alias(f"n_{f}") for f in "ANR"], *[low(*name).alias(name) for name in lowest])
    named = counted.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    # A key may have several rows in the institute table: equal names add up, others are rows of their own.
    total = lambda flag: F.nullif(F.sum(f"n_{flag}"), F.lit(0))
    counts = named.groupBy(
        "l_suppkey", code.alias("inst_id"), F.concat(F.lit("ITI "), "s_name").alias("inst"),
        _kind(F.col("s_acctbal")).alias("kind"), "p_brand", "academic_year",
    ).agg(F.sum("n_all").alias("n"), total("A").alias("a"), total("N").alias("b"), total("R").alias("c"), *[F.min(name).alias(name) for name in lowest])
    stage = lambda number, s: F.struct(
        F.lit(number).alias("SelectionStage"), F.col(f"A{s}").alias("10thPassUR_F"), F.col(f"N{s}").alias("Loc10thPassSC_M"))
    return counts.select(
        F.col("inst_id").alias("sams_code"), F.concat(F.lit("N"), "l_suppkey").alias("ncvtmis_code"), "academic_year", of_trade.alias("module"),
        F.col("inst").alias("institute_name"), F.col("kind").alias("type_of_institute"), F.lit(1).alias("admission_type"),
        F.col("p_brand").alias("trade"), F.when(of_trade == "Diploma", F.col("p_brand")).alias("branch"),
        F.to_json(F.struct(F.col("a").alias("Strength_UR"), F.col("b").alias("StrengthSC"), F.col("c").alias("StrengthST"), F.col("n").alias("Strength_Total"))).alias("strength"),
        F.to_json(F.struct(F.col("a").alias("UR"), F.col("b").alias("SC"))).alias("enrollment"),
        F.to_json(F.array(stage("1", "F"), stage("2", "O"))).alias("cutoff"),
    )


def of_module(df: DataFrame, module: str) -> DataFrame:
    return df.where(F.col("module") == module)


def _sql_case(column: str, table: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


CTES = f"""
lines AS (SELECT l.*, 'ITI ' || s_name AS inst, n_name AS inst_district, CASE WHEN s_acctbal>=5000 THEN 'Govt.' ELSE 'Pvt.' END AS kind,
 p_brand, p_type, p_size, 'S' || l_suppkey AS inst_id, {_sql_case('l_returnflag', STREAMS)} AS stream, {_sql_case('l_returnflag || l_linestatus', STATUSES)} AS status
 FROM lineitem l JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey JOIN part ON l_partkey=p_partkey),
line1 AS (SELECT * FROM lines QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice)=1),
people AS (SELECT o_orderkey, 'B' || o_orderkey AS barcode, 'A' || o_custkey AS aadhar_no, CAST(year(o_orderdate)+22 AS INTEGER) AS academic_year,
 {_sql_case('o_orderpriority', MODULES)} AS module, c_name AS student_name, CASE WHEN c_acctbal<5000 THEN 'Female' ELSE 'Male' END AS gender,
 CAST(o_orderdate - INTERVAL 6570 DAY AS DATE) AS dob, {_sql_case('c_mktsegment', CATEGORIES)} AS social_category, n_name AS district, r_name AS state,
 'Block ' || c_mktsegment AS block, c_name || ', Block ' || c_mktsegment || ', ' || n_name || ', ' || r_name || ' 75' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS address,
 CASE WHEN o_totalprice<100000 THEN 'Upto 2.5 lakh' WHEN o_totalprice<300000 THEN 'Between 2.5 To 8 lakh' WHEN o_totalprice<450000 THEN 'Above 8 lakh' ELSE '--' END AS raw_income,
 CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' END AS phase, o_orderdate AS date_of_application, o_totalprice>490000 AS orphan,
 CASE WHEN o_totalprice>=20000 THEN o_totalprice<30000 END AS gc, o_totalprice<40000 AS ph, c_acctbal>9500 AS es, c_acctbal>9000 AS ews,
 ROUND(o_totalprice/4500,2) AS percentage, CAST(floor(o_totalprice/1000) AS DOUBLE) AS secured_marks, CAST(year(o_orderdate) AS INTEGER) AS order_year,
 c_acctbal, c_nationkey, o_orderstatus
 FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey),
best_exam AS (SELECT l_orderkey, CASE WHEN bool_or(l_returnflag='N') THEN '12th' WHEN bool_or(l_returnflag='R') THEN 'ITI' ELSE '10th' END AS exam FROM lineitem GROUP BY 1),
enrolled AS (SELECT p.*, inst_id AS sams_code, inst AS reported_institute, p_brand AS reported_branch_or_trade, inst_district AS institute_district, kind AS type_of_institute,
 CASE WHEN p_size<=25 THEN '1 Year' ELSE '2 Years' END AS course_period, district=inst_district AS local,
 CASE WHEN module='Diploma' THEN CASE raw_income WHEN 'Upto 2.5 lakh' THEN '0-2,50,000' WHEN 'Between 2.5 To 8 lakh' THEN '2,50,000-8,00,000' WHEN 'Above 8 lakh' THEN 'Above 8,00,000' ELSE 'OTHER' END ELSE raw_income END AS annual_income,
 CASE p_type WHEN 'ECONOMY' THEN 'Graduate and above' WHEN 'LARGE' THEN 'Diploma' WHEN 'MEDIUM' THEN 'ITI' WHEN 'PROMO' THEN '10th' WHEN 'SMALL' THEN '12th' ELSE CASE WHEN module='Diploma' THEN exam END END AS highest_qualification
 FROM people p JOIN line1 ON o_orderkey=l_orderkey JOIN best_exam USING (l_orderkey)),
marks AS (SELECT aadhar_no, academic_year, module, exam_name, roll_no, secured_marks, total_marks, secured_marks/total_marks*100 AS percentage, year_of_passing,
 highest_qualification_exam_board, compartmental_status FROM (SELECT aadhar_no, academic_year, module,
 CASE l_returnflag WHEN 'A' THEN CASE WHEN module='ITI' THEN '10th Pass' ELSE '10th' END WHEN 'N' THEN '+2 Science' ELSE 'ITI' END AS exam_name,
 CAST(l_partkey AS VARCHAR) AS roll_no, CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS secured_marks, CAST(50 AS DOUBLE) AS total_marks,
 CAST(year(l_shipdate)-l_linenumber+1 AS VARCHAR) AS year_of_passing, CASE WHEN l_linestatus='O' THEN 'BSE, ODISHA' ELSE 'CBSE' END AS highest_qualification_exam_board,
 l_tax>0.06 AS compartmental_status, date_of_application, barcode, l_linenumber, l_suppkey, l_partkey, l_extendedprice FROM people JOIN lines ON o_orderkey=l_orderkey)
 QUALIFY ROW_NUMBER() OVER (PARTITION BY module, aadhar_no, academic_year, exam_name ORDER BY date_of_application, barcode, l_linenumber, l_suppkey, l_partkey, l_extendedprice)=1),
inst AS (SELECT inst_id AS sams_code, l_suppkey, inst AS institute_name, kind AS type_of_institute, p_brand AS trade, CAST(year(o_orderdate)+22 AS INTEGER) AS academic_year,
 CASE WHEN p_brand<'Brand#2' THEN 'ITI' ELSE 'Diploma' END AS module, CASE WHEN p_brand>='Brand#2' THEN p_brand END AS branch, COUNT(*) AS n,
 NULLIF(COUNT(*) FILTER (l_returnflag='A'),0) AS a, NULLIF(COUNT(*) FILTER (l_returnflag='N'),0) AS b, NULLIF(COUNT(*) FILTER (l_returnflag='R'),0) AS c,
 MIN(CAST(l_quantity AS INTEGER)) FILTER (l_returnflag='A' AND l_linestatus='F') AS af, MIN(CAST(l_quantity AS INTEGER)) FILTER (l_returnflag='A' AND l_linestatus='O') AS ao,
 MIN(CAST(l_quantity AS INTEGER)) FILTER (l_returnflag='N' AND l_linestatus='F') AS nf, MIN(CAST(l_quantity AS INTEGER)) FILTER (l_returnflag='N' AND l_linestatus='O') AS no
 FROM lines JOIN orders ON l_orderkey=o_orderkey GROUP BY ALL),
strength AS (SELECT sams_code, trade, branch, module, academic_year, category, CAST(v AS DOUBLE) AS strength FROM (
 SELECT *, 'UR' AS category, a AS v FROM inst UNION ALL SELECT *, 'SC', b FROM inst UNION ALL SELECT *, 'ST', c FROM inst UNION ALL SELECT *, 'Total', n FROM inst)),
cutoffs AS (SELECT sams_code, trade, academic_year, institute_name, module, selection_stage, applicant_type, CAST(v AS DOUBLE) AS cutoff,
 applicant_type LIKE 'Loc%' AS local, '10th Pass' AS qual, CASE WHEN applicant_type LIKE '%UR%' THEN 'UR' ELSE 'SC' END AS social_category,
 CASE WHEN applicant_type LIKE '%_F' THEN 'Female' ELSE 'Male' END AS gender FROM (
 SELECT *, '1' AS selection_stage, '10thPassUR_F' AS applicant_type, af AS v FROM inst UNION ALL SELECT *, '2', '10thPassUR_F', ao FROM inst
 UNION ALL SELECT *, '1', 'Loc10thPassSC_M', nf FROM inst UNION ALL SELECT *, '2', 'Loc10thPassSC_M', no FROM inst)),
vac AS (SELECT e.sams_code, e.academic_year, e.reported_branch_or_trade AS trade, e.type_of_institute, s.module, s.category, CAST(e.n AS INTEGER) AS enrollment,
 CAST(s.strength AS INTEGER) AS strength, CAST(s.strength-e.n AS INTEGER) AS vacancies, (s.strength-e.n)/s.strength AS vacancy_ratio
 FROM (SELECT sams_code, academic_year, reported_branch_or_trade, type_of_institute, COUNT(aadhar_no) AS n FROM enrolled WHERE module='ITI' GROUP BY ALL) e
 JOIN (SELECT * FROM strength WHERE category='Total' AND module='ITI') s ON s.sams_code=e.sams_code AND s.academic_year=e.academic_year AND s.trade=e.reported_branch_or_trade)"""


def sql(body: str) -> str:
    """The body behind the stand-in CTEs."""
    return f"WITH {CTES.strip()}\n{body.strip()}"


# --- cleaned datasets used by many queries ----------------------------------------

@described_once
def enrolled(t: Tables, module: str) -> DataFrame:
    from rollbook.plans.vocational import enrollments

    return enrollments(students(t, module), module, sort=False)


@described_once
def mark_rows(t: Tables, module: str) -> DataFrame:
    from rollbook.plans.vocational import marks

    return marks(enrolled(t, module))


@described_once
def strength(t: Tables, module: str) -> DataFrame:
    from rollbook.plans.vocational import institutes_strength

    # All rows have seats. Asked for here, seats are part of each pass, and the passes over all years are one plan.
    return institutes_strength(institutes(t, module).where(F.col("strength").isNotNull()))


@described_once
def cutoff_rows(t: Tables, module: str = "ITI") -> DataFrame:
    from rollbook.plans.vocational import institutes_cutoffs

    return institutes_cutoffs(institutes(t, module))


@described_once
def vacancy_rows(t: Tables) -> DataFrame:
    from rollbook.plans.vocational import vacancies

    return vacancies(enrolled(t, "ITI"), strength(t, "ITI"))


@described_once
def hss_options(t: Tables) -> DataFrame:
    from rollbook.plans.higher import hss_applications

    return hss_applications(students(t, "HSS"))


@described_once
def hss_mark_rows(t: Tables) -> DataFrame:
    """HSS results with numbers for marks."""
    from rollbook.functions.values import number
    from rollbook.plans.higher import hss_marks

    rows = hss_marks(students(t, "HSS"))
    return rows.withColumns({c: number(F.col(c)) for c in ["percentage", "secured_marks", "comp_fail_mark", "comp_pass_mark"]})


@described_once
def itemised(t: Tables) -> DataFrame:
    """ITI applications with the person's enrolment columns and the option's institute type."""
    from rollbook.plans.vocational import applications

    people_rows = enrolled(t, "ITI")
    keep = ["barcode", "aadhar_no", "academic_year", "sams_code", "reported_institute", "reported_branch_or_trade", "district"]
    return applications(people_rows, keep)
